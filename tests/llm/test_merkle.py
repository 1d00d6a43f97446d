"""Merkle manifest against plain Python."""
import hashlib
import random
import zlib

import pytest
from starloom.llm.merkle import report


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """(root, [(left, right), ...] of each node)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, i in enumerate(at):
            lo = i - i % 3
            paths[k].append(("".join(level[lo:i]), "".join(level[i + 1:lo + 3])))
        at = [i // 3 for i in at]
        level = [h("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
    return (level[0] if level else None), paths


def by_hand(rows):
    """Rows (doc_id, source, lang, n_chars, text) -> result tuples."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    climbed = {s: climb([leaf(r) for r in trees[s]]) for s in sources}
    root, above = climb([climbed[s][0] for s in sources])
    out = []
    for s, up in zip(sources, above):
        subroot, paths = climbed[s]
        for r, path in zip(trees[s], paths):
            path = path + up
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            acc = leaf((*r[:4], text))
            for left, right in path:
                acc = h(left + acc + right)
            out.append((r[0], leaf(r), subroot, root, h("".join(a + b for a, b in path)), acc, acc == root))
    return sorted(out, key=repr)


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, idx int, tree string, leaf int, n double, digest string"


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "t", 2, 0.5, "d") for r in rows], COLUMNS)
    got = sorted((tuple(r) for r in report(df).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                                      "verified").collect()), key=repr)
    assert got == by_hand(rows)


def some_rows(seed, n, sources):
    rng = random.Random(seed)
    texts = [None, "", "a\nb", "äöü\n\n", "plain", "\n"]
    return [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 3, -1]), rng.choice(texts) if rng.random() < .7 else f"t{i}\n")
            for i in rng.sample(range(-20, 10 * n), n)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_trees_of_all_sizes(spark, n):
    check(spark, [(i, "s", "en", 1, f"x{i}\n") for i in range(n)])


def test_many_sources_and_edge_cases(spark):
    rows = some_rows(1, 130, [None, "", "a", "b", "ä", "Z", "😀", "￿"]) + [(i, "hot", None, 1, "y\nz") for i in range(500, 590)]
    rows += rows[:3] * 2 + [(None, "a", None, None, "t\n"), (None, None, None, None, None), (1000, "only", "en", 2, "long\n" * 200_000)]
    rows += [(7, "tie", "en", 1, t) for t in ("b\n", "a\n", None, "a\n")]
    check(spark, rows)


def test_copies_of_one_row(spark):
    check(spark, [(2, "s", "en", 3, "x\ny")] * 50 + [(3, "s", "en", 3, "x")])


def test_nothing(spark):
    check(spark, [])
