import re

import numpy as np
import xxhash

from natatio.llm import simhash


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints):
    ids = sorted(prints)
    group = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if (prints[i] ^ prints[j]).bit_count() <= 3 and group[j] > group[i]:
                    group[j], changed = group[i], True
    return group


def test_groups_match_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [" ".join(rng.choice(["Thé", "of", "ndea", "Wh.", "x y"], 60)) for _ in range(12)]
    texts = {i: t for i, t in enumerate(base)}
    texts |= {100 + i: t for i, t in enumerate(base[:5])}
    texts |= {200 + i: base[0] + " tail" * i for i in range(6)}
    texts |= {300: None, 301: "", 302: " \t\n", 303: "one", 304: "two words", 305: "word " * 300_000}
    frame = spark.createDataFrame([(i, t, "clash") for i, t in texts.items()], "doc_id long, text string, fp string")
    got = {r.doc_id: r for r in simhash.simhash_groups(frame).collect()}
    prints = {i: slow_print(t) for i, t in texts.items()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == slow_groups(prints)


def test_empty_table_and_repeated_rows(spark):
    assert simhash.simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = simhash.simhash_groups(spark.createDataFrame([(7, "a b c")] * 3, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.component_id) for r in rows] == [(7, 7)] * 3


def test_trie_links_are_complete():
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in rng.integers(0, 6, 400)]
    a = np.unique(seeds[rng.integers(0, 40, 400)] ^ np.array(flips))
    found = {(int(i), int(j)) for x, y in simhash.trie_links(a, a, 3) for i, j in zip(x, y)}
    assert found == {(i, j) for i in range(len(a)) for j in range(i + 1, len(a)) if int(a[i] ^ a[j]).bit_count() <= 3}
    b = np.unique(a[::3] ^ np.uint64(5))
    found = {(int(i), int(j)) for x, y in simhash.trie_links(a, b, 3) for i, j in zip(x, y)}
    assert found == {(i, j) for i in range(len(a)) for j in range(len(b)) if int(a[i] ^ b[j]).bit_count() <= 3}
