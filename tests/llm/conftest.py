import random

import pytest

SF = "/root/testdata/sf0.001"
# Columns whose names the operators use themselves.
EXTRA = {"lang": "en", "source": "s", "n_chars": 1, "piece": 7, "length": 8, "rank": 9, "node": 1, "bucket": 2,
         "k1": 3, "mark": 1, "picked": 5, "block": 6, "sketch": "x", "key": "y", "h": 1, "score": 0.5}


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """These tests run many small jobs."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns of clashing names."""
    names = ", ".join(f"{c} {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}"
                      for c, v in EXTRA.items())

    def make(rows, **columns):
        extra = {**EXTRA, **columns}
        return spark.createDataFrame([(i, t, *extra.values()) for i, t in rows], f"doc_id long, text string, {names}")
    return make


WORDS = "the of and a in to is was he for it with as his on be at by had not are but from or have an they".split()


def prose(rng, n):
    """Words that differ between texts, with line breaks."""
    words = [rng.choice(WORDS) + str(rng.randrange(400)) if rng.random() < 0.8 else rng.choice(WORDS) for _ in range(n)]
    return "".join(w + ("\n" if rng.random() < 0.08 else " ") for w in words)


@pytest.fixture(scope="session")
def corpus():
    """Edge cases, exact copies, near copies of one text, ties and repeated rows."""
    rng = random.Random(11)
    texts = [None, "", " \t\n \n", "one", "two words", "Ünïcode é́ 😀 　 x\x1cy", "\n\n\n"]
    texts += [prose(rng, rng.choice([3, 30, 120, 300])) for _ in range(30)]
    texts += [prose(rng, 6000), "nospace" * 2000]
    base = prose(rng, 400)
    for _ in range(25):
        words = base.split(" ")
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "edit" + str(rng.randrange(1000))
        texts.append(" ".join(words))
    texts += [texts[10]] * 5 + [texts[12] + "\nshared line of some length"] * 2
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    return rows + rows[8:10] + [(None, texts[9]), (None, "a text without an id")]
