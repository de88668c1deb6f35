import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from natatio.llm import mixing


def fill(budget, children):
    """Shares of {name: (weight, room)}: fill who can't take the fair share, again and again."""
    budget = min(budget, sum(r for _, r in children.values()))
    out, open_ = {}, dict(children)
    while open_:
        rate = Fraction(budget - sum(out.values()), sum(w for w, _ in open_.values()))
        full = [k for k, (w, r) in open_.items() if r <= w * rate]
        if not full:
            parts = {k: int(w * rate) for k, (w, _) in open_.items()}
            left = budget - sum(out.values()) - sum(parts.values())
            for k in sorted(parts)[:left]:
                parts[k] += 1
            return out | parts
        for k in full:
            out[k] = open_.pop(k)[1]
    return out


def slow(rows, share, epochs, seed=7):
    w = {"domain": lambda d: {"d0": 6, "d1": 5, "d2": 4, "d3": 3}.get(d, 2), "language": lambda x: {"en": 6, "de": 3, "fr": 3}.get(x, 1), "source": lambda s: 2 if s == "src0" else 1}
    leaves = defaultdict(list)
    for i, text, lang, source in rows:
        if n := len((text or "").split()):
            number = source[3:] if source else ""
            leaves[f"d{int(number) % 5}" if number.isdigit() else "?", lang or "?", source or "?"].append((i, text, n))
    room = {k: sum(n for _, _, n in v) * epochs for k, v in leaves.items()}
    part = lambda *at: {k[len(at)] for k in leaves if k[: len(at)] == at}
    total = lambda *at: sum(r for k, r in room.items() if k[: len(at)] == at)
    out = []
    for d, a in fill(int(sum(room.values()) // epochs * share), {d: (w["domain"](d), total(d)) for d in part()}).items():
        for x, b in fill(a, {x: (w["language"](x), total(d, x)) for x in part(d)}).items():
            for s, c in fill(b, {s: (w["source"](s), total(d, x, s)) for s in part(d, x)}).items():
                epoch = 0
                while c > 0:
                    key = lambda r: (hashlib.md5(f"{seed}:{epoch}:{r[0]}".encode()).hexdigest(), str(r[0]), r[1])  # noqa: B023,E731
                    for i, _, n in sorted(leaves[d, x, s], key=key):
                        if c > 0:
                            out.append((i, d, epoch, n, min(n, c)))
                            c -= n
                    epoch += 1
    return sorted(out)


def made(spark, rows, share, epochs):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n long")
    got = mixing.standard_mix(docs, share, epochs)
    assert got.columns[:5] == docs.columns
    return sorted(map(tuple, got.select("doc_id", "mix_domain", "mix_epoch", "mix_tokens", "mix_taken").collect()))


def corpus(n, seed):
    r = random.Random(seed)
    return [(i, r.choice([None, "", "a b\tc", "one two  three four " * r.randint(1, 9), "x"]), r.choice(["en", "de", "fr", "es", None]), r.choice([f"src{k}" for k in range(7)] + ["src0"] * 6 + [None, "odd"])) for i in range(n)]


@pytest.mark.parametrize("share,epochs", [(0.3, 1), (0.7, 4), (2.5, 2)])
def test_matches_brute_force(spark, share, epochs):
    rows = corpus(150, 4) + [(20, "twin " * 5, "en", "src0")] * 3
    assert made(spark, rows, share, epochs) == slow(rows, share, epochs)


def test_shortage_stays_with_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 10), ("a", "x", "2", 500), ("a", "y", "1", 500), ("b", "x", "1", 500)], "domain string, language string, source string, tokens long")
    even = {k: F.lit(1) for k in mixing.LEVELS}
    got = {r[:3]: r.share for r in mixing.budgets(leaves, 400, even, 1).collect()}
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 90, ("a", "y", "1"): 100, ("b", "x", "1"): 200}


def test_edges(spark):
    assert made(spark, [], 0.5, 2) == []
    assert made(spark, [(1, None, "en", "src0"), (2, " ", None, None)], 0.5, 2) == []
    docs = spark.createDataFrame([(None, "a b c", "en", "src0"), (None, "d e", "en", "src0")], "doc_id long, text string, lang string, source string")
    assert sum(r.mix_taken for r in mixing.standard_mix(docs, 0.8, 1).collect()) == 4


def test_columns_of_these_names_are_replaced(spark):
    docs = spark.createDataFrame([(*r, "given", -1) for r in corpus(40, 2)], "doc_id long, text string, lang string, source string, mix_domain string, mix_taken int")
    got = mixing.standard_mix(docs, 0.5, 2)
    assert got.columns == ["doc_id", "text", "lang", "source", "mix_domain", "mix_epoch", "mix_tokens", "mix_taken"]
    assert "given" not in {r.mix_domain for r in got.collect()}


def test_dots_in_names_and_a_very_long_text(spark):
    rows = [*corpus(40, 3), (900, "word " * 300_000, "en", "src0")]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, lang string, source string, `a.b` int")
    got = mixing.standard_mix(docs, 0.9, 1)
    assert "a.b" in got.columns and {r.doc_id: r["a.b"] for r in got.collect()}.items() <= {r[0]: n for n, r in enumerate(rows)}.items()
    assert sorted(map(tuple, got.select("doc_id", "mix_domain", "mix_epoch", "mix_tokens", "mix_taken").collect())) == slow(rows, 0.9, 1)


def test_oracle_agrees_on_null_ids(spark):
    rows = [(None, f"{'w ' * (k + 1)}", "en", "src0") for k in range(30)] + [(7, "one two", "en", "src0")]
    db = duckdb.connect()
    db.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    db.executemany("insert into documents values (?, ?, ?, ?)", rows)
    want = db.execute(f"select doc_id, mix_domain, mix_epoch, mix_tokens, mix_taken from ({mixing.standard_mix_sql(0.4, 1)})").fetchall()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.standard_mix(docs, 0.4, 1).select("doc_id", "mix_domain", "mix_epoch", "mix_tokens", "mix_taken").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and any(r.doc_id is None for r in got)


def test_oracle_agrees(spark):
    rows = corpus(200, 9)
    db = duckdb.connect()
    db.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    db.executemany("insert into documents values (?, ?, ?, ?)", rows)
    want = db.execute(f"select doc_id, mix_domain, mix_epoch, mix_tokens, mix_taken from ({mixing.standard_mix_sql(0.7, 3)})").fetchall()
    assert sorted(want) == made(spark, rows, 0.7, 3)
