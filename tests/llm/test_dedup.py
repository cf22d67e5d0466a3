import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_data import prose

from lakemoor.llm import textkernel as K
from lakemoor.llm.components import components
from lakemoor.llm.exact_dedup import exact_dedup, grace, keep_first, normalise
from lakemoor.llm.near_dedup import keep_one, near_dedup, prob_minhash, probability_jaccard, profiles


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def order(x):
    return (x is None, x or 0)


def test_normalise():
    for t in (None, "", " ", "a", " a", "a ", "\t a \n b\x0b", "  a"):
        assert normalise(None if t is None else t.encode()) == plain(t).encode()


@pytest.mark.parametrize("budget", [64 << 20, 2000])
def test_exact_against_brute_force(frame, odd_docs, budget):
    groups = defaultdict(list)
    for i, t in odd_docs:
        groups[plain(t)].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = min(ids, key=order)
        for n, i in enumerate(sorted(ids, key=order)):
            want[i, keep, len(ids), n == 0, hashlib.sha256(t.encode()).hexdigest()] += 1
    got = Counter(map(tuple, exact_dedup(frame(odd_docs), budget=budget).collect()))
    assert got == want
    kept = keep_first(frame(odd_docs), budget=budget)
    assert kept.columns == frame(odd_docs).columns
    assert Counter((r.doc_id, plain(r.text)) for r in kept.collect()) == Counter((min(ids, key=order), t) for t, ids in groups.items())


def test_grace_spills_and_survives_equal_hashes(tmp_path):
    contents = [str(i % 300).encode() * 30 for i in range(2000)]
    for h in (lambda c: 5, lambda c: int.from_bytes(hashlib.sha256(c).digest()[:8], "little")):
        got = {c: sorted(m) for c, m in grace(((h(c), c, i) for i, c in enumerate(contents)), str(tmp_path), budget=4000)}
        assert got == {c: [i for i, x in enumerate(contents) if x == c] for c in set(contents)}
        assert not list(tmp_path.iterdir())


def test_grace_keeps_the_best_row_of_a_hot_class(tmp_path):
    held = []

    def records():
        for i in range(5000):
            held.append(sum(len(p.read_bytes()) for p in tmp_path.iterdir()))
            yield 7, b"hot", (i * 7919 % 5000, b"x" * 1000)

    assert [m for _, m in grace(records(), str(tmp_path), budget=50_000, best=min, size=lambda m: len(m[1]))] == [[(0, b"x" * 1000)]]
    assert not any(held)  # nothing is spilled, as one row alone is kept


def test_empty_tables(frame):
    for f in (exact_dedup, keep_first, near_dedup, keep_one):
        assert f(frame([])).collect() == []


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def bag(t):
    w = words_of(t)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jp(a, b):
    total = 0.0
    for d in a.keys() & b.keys():
        total += 1 / sum(max(a[x] / a[d], b[x] / b[d]) for x in a.keys() | b.keys())
    return total


def test_kernel_words_and_shingles():
    texts = ["A b-c. D", None, "", "é!É 12", "x" * 300000 + " y", "a b c d e f", "a b c d e f g"] + [prose(i, 3000) for i in range(30)]
    buf, offs = K.column_bytes(pa.array([None if t is None else t.encode() for t in texts], pa.binary()))
    h, s, e, first = K.words(buf, offs)
    names = {}
    for i, t in enumerate(texts):
        own = words_of(t)
        assert first[i + 1] - first[i] == len(own)
        for k, w in zip(h[first[i] : first[i + 1]].tolist(), own, strict=True):
            assert names.setdefault(k, w) == w
    sh, rows = K.shingles(h, first, 5)
    for i, t in enumerate(texts):
        assert (rows == i).sum() == sum(bag(t).values())
    assert set(sh[rows == 5].tolist()) < set(sh[rows == 6].tolist())


def test_probability_jaccard_and_its_estimate():
    rng = np.random.default_rng(1)
    for k in range(20):
        a = Counter({int(x): int(c) for x, c in zip(rng.integers(0, 60, 40), rng.integers(1, 4, 40), strict=True)})
        b = Counter({int(x): int(c) for x, c in zip(rng.integers(0, 60, 40), rng.integers(1, 4, 40), strict=True)})
        arrays = [(np.array(sorted(x), dtype=np.uint64), np.array([x[i] for i in sorted(x)])) for x in (a, b)]
        exact = jp(a, b)
        assert probability_jaccard(*arrays) == pytest.approx(exact)
        e = K.mix(np.concatenate([arrays[0][0], arrays[1][0]]))
        sig = prob_minhash(e, np.concatenate([arrays[0][1], arrays[1][1]]), np.repeat([0, 1], [len(a), len(b)]), 2, 4000)
        assert (sig[0] == sig[1]).mean() == pytest.approx(exact, abs=0.05)


def near_rows():
    base = [prose(50 + i, 200).split() for i in range(12)]
    rows = []
    for i, w in enumerate(base):
        rows.append((10 * i, " ".join(w)))
        for k in range(1, 6):
            v = list(w)
            for j in range(k * (1 + i % 4)):
                v[(37 * j + 11 * k) % len(v)] = f"new{i}x{k}x{j}"
            rows.append((10 * i + k, " ".join(v)))
    shared = prose(99, 60)
    rows += [(1000 + i, shared + " " + prose(200 + i, 70)) for i in range(20)]  # a passage in common is no near copy
    rows += [(2000 + i, prose(7, 150) + f" end{i}") for i in range(60)]  # one large group
    return rows


def brute(rows):
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = words_of(rows[i][1]) == words_of(rows[j][1]) if bags[i] else plain_bytes(rows[i]) == plain_bytes(rows[j]) and not bags[j]
            if same or bags[i] and bags[j] and min(sum(bags[i].values()), sum(bags[j].values())) * 2 > max(sum(bags[i].values()), sum(bags[j].values())) and (bags[i] & bags[j]) and jp(bags[i], bags[j]) >= 0.8 - 1e-9:
                root[find(i)] = find(j)
    out = defaultdict(list)
    for i, r in enumerate(rows):
        out[find(i)].append(r[0])
    return Counter((i, min(ids, key=order), len(ids)) for ids in out.values() for i in ids)


def plain_bytes(row):
    return (row[1] or "").encode()


def test_near_against_brute_force(frame):
    rows = near_rows()
    want = brute(rows)
    assert Counter(map(tuple, near_dedup(frame(rows)).collect())) == want
    kept = keep_one(frame(rows))
    assert kept.columns == frame(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in want})


def changed(words, places, name):
    """4 words of 200 replaced: similarity 0.815."""
    v = list(words)
    for j in places:
        v[j] = f"{name}x{j}"
    return v


def test_near_copies_of_copies(frame):
    base = prose(300, 400).split()[:200]
    rows, first = [(0, base)], [3, 53, 103, 153]
    for i in range(1, 700):
        rows.append((i, changed(base, [p + i % 17 for p in first], f"m{i}")))
    for i in range(1, 31):
        rows.append((1000 + i, changed(rows[i][1], [p + 25 for p in first], f"n{i}")))
    texts = {i: " ".join(w) for i, w in rows}
    for i in range(1, 31):
        copy, member = bag(texts[1000 + i]), bag(texts[i])
        assert jp(copy, member) >= 0.8 > 0.7 > jp(copy, bag(texts[0])) and jp(member, bag(texts[0])) >= 0.8
    got = Counter((r.class_id, r.class_size) for r in near_dedup(frame(list(texts.items()))).collect())
    assert got == {(0, len(texts)): len(texts)}


def test_near_groups_linked_by_other_members(frame):
    """Two groups of near copies whose only link is between members that stand for neither."""
    base, first = prose(400, 400).split()[:200], [3, 53, 103, 153]
    x = changed(base, first, "x")
    y = changed(x, [p + 12 for p in first], "y")
    other = changed(y, [p + 24 for p in first], "z")
    rows = [(0, base), (1, x), (2, y), (3, other)]
    for i in range(30):
        rows += [(100 + i, changed(base, [p + 30 + i % 10 for p in first], f"p{i}")), (200 + i, changed(other, [p + 30 + i % 10 for p in first], f"q{i}"))]
    texts = {i: " ".join(w) for i, w in rows}
    assert jp(bag(texts[1]), bag(texts[2])) >= 0.8 > max(jp(bag(texts[0]), bag(texts[2])), jp(bag(texts[1]), bag(texts[3])))
    assert {r.class_size for r in near_dedup(frame(list(texts.items()))).collect()} == {len(texts)}


def test_near_chains_and_edit_clusters(frame):
    """Windows that slide over one text, and copies of copies with some words edited: links in rows, with no centre."""
    rng, texts = np.random.default_rng(3), []
    for c in range(12):
        w = prose(1000 + c, 400).split()
        texts += [w[18 * k : 18 * k + 200] for k in range(12)]
    for c in range(10):
        members = [prose(5000 + c, 200).split()]
        for k in range(13):
            v = list(members[int(rng.integers(len(members)))])
            for j in rng.choice(200, 3 + k % 4, replace=False):
                v[j] = f"e{c}x{k}x{j}"
            members.append(v)
        texts += members
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    assert Counter(map(tuple, near_dedup(frame(rows)).collect())) == brute(rows)


def test_profiles_bound_the_similarity():
    rng = np.random.default_rng(5)
    for _ in range(50):
        a, b = (Counter(map(int, rng.integers(0, 120, 90))) for _ in range(2))
        (e, w), (f, v) = [(K.mix(np.array(sorted(x), dtype=np.uint64)), np.array([x[i] for i in sorted(x)])) for x in (a, b)]
        shares = profiles(np.concatenate([e, f]), np.repeat([0, 1], [len(e), len(f)]), np.concatenate([w, v]), 2)
        assert np.minimum(shares[0], shares[1]).sum() >= jp(a, b) - 1e-5


def test_near_odd_rows(frame, odd_docs):
    rows = [r for r in odd_docs if len(r[1] or "") < 10000] + [(31, prose(1, 3000)), (32, prose(1, 3000) + " tail")]
    want = brute(rows)
    assert Counter(map(tuple, near_dedup(frame(rows)).collect())) == want
    kept = Counter(r.doc_id for r in keep_one(frame(rows)).collect())
    classes = Counter()
    for (_, c, n), times in want.items():
        classes[c, n] += times
    assert kept == Counter(c for (c, n), times in classes.items() for _ in range(times // n))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {k: 100 for k in range(100, 160)} | {200: 200, 201: 200}
    assert got == want
