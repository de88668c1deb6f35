import random

import numpy as np

from natatio.llm import lines


def runs(key):
    """All runs of lines with enough characters, by plain loops."""
    return {key[i:m] for i in range(len(key)) for m in range(i + 1, len(key) + 1) if sum(map(len, key[i:m])) >= lines.BLOCK_CHARS}


def gone_lines(rows):
    """Numbers of the lines that go. Every kind is aligned with the earliest holder of each shortest run that starts or ends at a line; no bounds."""
    kinds = {}
    for i, t in rows:
        key = tuple(x.strip() for x in t.split("\n"))
        kinds[key] = min(kinds.get(key, i), i)
    seeds = {}
    for key in kinds:
        every = runs(key)
        seeds[key] = {x for x in every if x[1:] not in every or x[:-1] not in every}
    out = {}
    for key, i in kinds.items():
        gone = set()
        for x in seeds[key]:
            first, other = min((kinds[k], k) for k in kinds if x in seeds[k])
            if other != key:
                ids = {y: n for n, y in enumerate(dict.fromkeys([*other, *key]))}
                gone.update(lines.blocks(lines.patience([ids[y] for y in other], [ids[y] for y in key]), [len(y) for y in key]))
        out[i] = gone
    return out


def slow(rows):
    gone = gone_lines(rows)
    return {i: "\n".join(y for n, y in enumerate(x.strip() for x in t.split("\n")) if n not in gone[i]) for i, t in rows}


def kept(spark, rows):
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.doc_id: r.kept for r in got}


def test_matches_brute_force_without_bounds(spark):
    r = random.Random(5)
    pool = [f"line {k} " + "x" * r.randint(0, 45) for k in range(40)] + ["", "ab", "a", "short one"]
    pool = [x.strip() for x in pool]
    rows = []
    for i in r.sample(range(1000), 130):
        body = [r.choice(pool) for _ in range(r.randint(0, 6))]
        start = r.randint(0, 40)
        rows.append((i, "\n".join([f"own {i}", *body, *pool[start : start + r.randint(1, 7)]])))
    assert kept(spark, rows) == slow(rows)


def test_line_that_many_texts_share(spark):
    """Over 64 texts hold the line, and the last one shares three rarer lines with another."""
    common = "permission is granted to copy this line of the licence"
    rare = [f"a rarer line that just two texts have, number {k}" for k in range(3)]
    rows = [(i, f"own text {i}\n{common}") for i in range(100)] + [(100, "\n".join(rare)), (101, "\n".join([rare[0], "x1", rare[1], "x2", rare[2], "x3", common]))]
    got = kept(spark, rows)
    assert got[0] == rows[0][1] and got[101] == "x1\nx2\nx3"
    assert all(got[i] == f"own text {i}" for i in range(1, 100))


def test_short_lines_and_a_line_that_was_alone_first(spark):
    verse = [f"verse {k} of many" for k in range(5)]
    two = ["a line of twenty-odd chars", "and one that goes with it"]
    rows = [(1, "one\n" + two[0]), (2, "two\n" + "\n".join(two)), (3, "\n".join([*two, "three"])), (4, "\n".join(["four", *verse, "end four"])), (5, "\n".join(["five", *verse, "end five"])), (6, two[1] + "\nsix")]
    got = kept(spark, rows)
    assert got[3] == "three" and got[5] == "five\nend five"
    assert {i: got[i] for i in (1, 2, 4, 6)} == {i: t for i, t in rows if i in (1, 2, 4, 6)}


def test_stretches_cover_each_run():
    r = random.Random(2)
    for _ in range(200):
        sizes = [r.choice([0, 0, 3, 10, 25, 60]) for _ in range(r.randint(0, 12))]
        key = tuple("x" * n for n in sizes)
        every = {(i, m) for i in range(len(key)) for m in range(i + 1, len(key) + 1) if sum(sizes[i:m]) >= lines.BLOCK_CHARS}
        least = {(i, m) for i, m in every if (i, m - 1) not in every or (i + 1, m) not in every}
        for i, m in every:
            assert set(range(i, m)) == {x for a, b in least if i <= a and b <= m for x in range(a, b)}
        got = lines.stretches(np.arange(1, len(key) + 1, dtype=np.int64) * 7919, np.array(sizes, np.int64))
        assert len(got) <= len(least) and bool(len(got)) == bool(every)
    assert len(lines.stretches(np.arange(1_000_000), np.zeros(1_000_000, np.int64))) == 0


def test_recall_against_aligning_all_pairs(spark):
    """On given documents: lines that some earlier document's alignment deletes, and how many of them go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    kinds, whole = {}, {}
    for x in sorted(docs.collect()):
        key = tuple(y.strip() for y in (x.text or "").split("\n"))
        whole[x.doc_id] = key
        kinds.setdefault(key, x.doc_id)
    holders, gone = {}, {}
    for key, i in sorted(kinds.items(), key=lambda t: t[1]):
        ids = {y: n for n, y in enumerate(dict.fromkeys(key))}
        others = {k for y in set(key) if y for k in holders.get(y, ())}
        for other in others:
            number = ids | {y: len(ids) + n for n, y in enumerate(dict.fromkeys(other)) if y not in ids}
            found = lines.blocks(lines.patience([number[y] for y in other], [number[y] for y in key]), [len(y) for y in key])
            gone.setdefault(i, set()).update(found)
        for y in set(key):
            if y:
                holders.setdefault(y, []).append(key)
    got = {r.doc_id: set(r.removed) for r in lines.common_blocks(docs).collect()}
    want = sum(len(v) for v in gone.values())
    kept = sum(len(v & got.get(i, set())) for i, v in gone.items())
    assert want > 300 and kept / want >= 0.9
    assert all(got.get(i, set()) <= v for i, v in gone.items())
