import difflib
import random

from natatio.llm import lines
from tests.llm.test_line_stretches import gone_lines as whole


def slow(rows):
    """The rule of ``test_line_stretches`` with all the odd rows: ids and texts that are null, and repeats."""
    first = {}
    for i, t in rows:
        if i is not None:
            key = tuple(x.strip() for x in (t or "").split("\n"))
            first[key] = min(first.get(key, i), i)
    told = whole([(i, "\n".join(key)) for key, i in first.items()])
    out = []
    for i, t in rows:
        lines_ = [] if t is None else t.split("\n")
        key = tuple(x.strip() for x in (t or "").split("\n"))
        if i is None or t is None:
            gone = set()
        elif first[key] != i:
            gone = set(range(len(key))) if sum(map(len, key)) >= lines.BLOCK_CHARS else set()
        else:
            gone = told[i]
        out.append((i, len(lines_), len(gone), "\n".join(x for n, x in enumerate(lines_) if n not in gone)))
    return sorted(out, key=str)


def check(spark, rows):
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kind int")
    assert sorted(map(tuple, lines.dedup_lines(frame).collect()), key=str) == slow(rows)


def test_matches_brute_force(spark):
    r = random.Random(3)
    pool = [f"line {k} " + "x" * r.randint(0, 30) for k in range(60)] + ["", "short", " padded line with spaces "]
    rows = []
    for i in r.sample(range(100), 50):
        body = [r.choice(pool) for _ in range(r.randint(1, 9))]
        if i % 2:
            start = r.randint(0, 50)
            body += pool[start : start + r.randint(2, 6)]
        rows.append((i, "\n".join(body)))
    rows += [(200 + k, rows[k][1]) for k in range(4)] + [(300, rows[0][1] + "\nnew last line of its own")]
    check(spark, rows)


def test_edges(spark):
    text = "a line that is long enough to count\nand a second one, long as well"
    check(spark, [(1, text), (2, text), (2, text), (None, text), (3, None), (4, ""), (5, "\n\n"), (6, "short"), (7, "short"), (8, "first\n" + text), (9, "word " * 200_000), (10, "word " * 200_000)])
    check(spark, [])


def test_patience_is_a_common_subsequence():
    r = random.Random(1)
    for _ in range(300):
        a, b = ([r.randint(0, 12) for _ in range(r.randint(0, 25))] for _ in range(2))
        got = lines.patience(a, b)
        assert all(a[i] == b[k] for i, k in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    a = list(range(30))
    b = a[:10] + [99, 98] + a[12:]
    assert lines.patience(a, b) == [(m.a + n, m.b + n) for m in difflib.SequenceMatcher(None, a, b, False).get_matching_blocks() for n in range(m.size)]
