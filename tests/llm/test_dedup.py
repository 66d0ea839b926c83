import hashlib
from collections import defaultdict

import numpy as np

from duskwork.llm import exact_dedup, line_dedup, ngram_join
from duskwork.llm.exact_dedup import PatriciaTrie, larger
from tests.llm.cases import docs, rows, with_nulls


def test_exact_duplicates_against_brute_force(spark):
    made = with_nulls(rows())
    groups = defaultdict(list)
    for r in made:
        groups[exact_dedup.normal_bytes(r[1] or "")].append(r[0])
    expected = []
    for r in made:
        key = exact_dedup.normal_bytes(r[1] or "")
        ids = [i for i in groups[key] if i is not None]
        keep = max(ids) if ids else None
        expected.append((r[0], keep, len(groups[key]), r[0] == keep, hashlib.sha256(key).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_duplicates(docs(spark, made)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert exact_dedup.exact_duplicates(docs(spark, [])).count() == 0


def test_trie_spills_finished_subtrees():
    keys = sorted({hashlib.md5(str(k).encode()).digest() * (1 + k % 40) for k in range(500)} | {b"", b"a", b"ab", b"abc"})
    trie, out = PatriciaTrie(larger), []
    for n, key in enumerate(key for key in keys for _ in range(2)):
        trie.insert(key, key, n, 1)
        if trie.bytes > 3000:
            out.extend(trie.spill(key))
            assert trie.bytes < 1000 + len(key)
    out.extend(trie.spill())
    assert sorted(e[0] for e in out) == keys and all(e[2] == 2 for e in out)


def plain_lines(made, least=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower()
    held = defaultdict(set)
    for r in made:
        for line in (r[1] or "").split("\n"):
            if len(key(line).decode()) >= least:
                held[key(line)].add(line_dedup.NO_ID if r[0] is None else r[0])
    out = []
    for r in made:
        lines = (r[1] or "").split("\n")
        own = line_dedup.NO_ID if r[0] is None else r[0]
        kept = [line for line in lines if len(held.get(key(line), ())) < 2 or min(held[key(line)]) == own]
        out.append((r[0], "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_line_dedup_against_brute_force(spark, monkeypatch):
    made = with_nulls(rows())
    got = [tuple(r) for r in line_dedup.deduplicated(docs(spark, made)).collect()]
    assert sorted(got, key=str) == sorted(plain_lines(made), key=str)
    assert sum(r[3] for r in got) > 10
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 3)
    monkeypatch.setattr(line_dedup, "PROBES", 2)
    again = [tuple(r) for r in line_dedup.deduplicated(docs(spark, made)).collect()]
    assert sorted(again, key=str) == sorted(got, key=str)
    assert line_dedup.deduplicated(docs(spark, [])).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    low, high = (rng.integers(0, 1 << 63, 5000, dtype=np.uint64) for _ in range(2))
    low[:50] = low[0]
    made = line_dedup.PerfectHash.load(line_dedup.PerfectHash.build(low, high).dump())
    assert sorted(made.slots(low, high)) == list(range(5000))


def brute_groups(made):
    sets = [set(ngram_join.shingles(r[1] or "").tolist()) for r in made]
    group = {r[0]: {r[0]} for r in made if r[0] is not None}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if made[i][0] is None or made[j][0] is None or not a or not b:
                continue
            if 100 * len(a & b) >= 75 * len(a | b) and group[made[i][0]] is not group[made[j][0]]:
                both = group[made[i][0]] | group[made[j][0]]
                for k in both:
                    group[k] = both
    return sorted(((r[0], len(s), min(group[r[0]]) if r[0] is not None else None) for r, s in zip(made, sets)), key=str)


def test_ngram_groups_against_brute_force(spark, monkeypatch):
    made = with_nulls(rows(many=60))
    monkeypatch.setattr(ngram_join, "HEAVY", 3)
    monkeypatch.setattr(ngram_join, "FREQUENT_COUNT", 3)
    got = [tuple(r) for r in ngram_join.groups(docs(spark, made)).collect()]
    assert sorted(got, key=str) == brute_groups(made)
    assert len({r[2] for r in got}) < len(got) - 20


def test_ngram_groups_of_nothing(spark):
    assert ngram_join.groups(docs(spark, [])).count() == 0
    kept = ngram_join.representatives(docs(spark, [(5, None, "", "", 0), (6, "", "", "", 0)]))
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6]


def test_shared_prefix_tokens_reach_the_least_number():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.integers(0, 1 << 62, 3, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        assert ngram_join.linked(a, b) == (100 * both >= 75 * (len(a) + len(b) - both))
