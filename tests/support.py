"""Values that test modules share."""
import datetime as dt


def ts(v):
    return None if v is None else dt.datetime.fromisoformat(v)
