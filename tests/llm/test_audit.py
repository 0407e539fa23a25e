"""Source divergence, spelling variants and SimHash links against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as t

from parcelflow.llm import divergence, simhash_cover, spelling
from tests.llm.helpers import frame, odd_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergence_brute(rows, min_docs, top):
    docs = [(a or "", b or "", TERM.findall((x or "").translate(LOWER))) for a, b, x in rows]
    inside, count, lang_count = Counter(), Counter(), Counter()
    for a, b, w in docs:
        inside.update((a, x) for x in set(w))
        count.update((a, b, x) for x in w)
        lang_count.update((a, x) for x in w)
    kept = defaultdict(list)
    for (a, x), d in sorted(inside.items()):
        if d >= min_docs:
            kept[a].append(x)
    groups = sorted({(a, b) for a, b, _ in docs})
    p, q = {}, {}
    for a, b in groups:
        v, n = len(kept[a]), sum(count[a, b, x] for x in kept[a])
        p[a, b] = [1 + 10**9 * (count[a, b, x] + 2) // (n + 2 * v) for x in kept[a]]
        n = sum(lang_count[a, x] for x in kept[a])
        q[a] = [1 + 10**9 * (lang_count[a, x] + 2) // (n + 2 * v) for x in kept[a]]
    f = lambda x, y: (x - y) ** 2 // (x + y)
    out = []
    for a, b in groups:
        pair = [(sum(map(f, p[a, b], p[a, c])), c) for l, c in groups if l == a and c != b]
        term = [(f(x, y), w) for x, y, w in zip(p[a, b], q[a], kept[a], strict=True) if count[a, b, w] and x > y]
        for part, found in (("pair", pair), ("term", term)):
            found.sort(key=lambda z: (-z[0], z[1].encode()))
            out += [(a, b, part, item, value, i) for i, (value, item) in enumerate(found, 1) if part == "pair" or i <= top]
    return sorted(out)


def audited(spark, rows, **how):
    kind = t.StructType([t.StructField(c, t.StringType()) for c in ("lang", "source", "text", "term", "n", "total", "value", "rank", "number")])
    df = spark.createDataFrame([(a, b, x, *"uvwxyz") for a, b, x in rows], kind)
    return sorted(tuple(r) for r in divergence.source_divergence(df, **how).collect())


def test_source_divergence(spark):
    rng = random.Random(5)
    letters = ["a", "b", "É", "ß", "中", "\U0001F600", "x1", "Q-", "__", "ab cd"]
    vocabulary = ["".join(rng.choices(letters, k=k)) for k in (1, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9, 12, 16, 20, 33, 60)] + ["abcdefgh", "abcdefghi", "abcdefgh" * 2, "abcdefgh" * 2 + "i", "z" * 200]
    rows = [(rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "s2", "S2", None, "é", "s10", "中"]), " ".join(rng.choices(vocabulary, k=rng.randrange(0, 40)))) for _ in range(150)]
    rows += [("de", "only", "a b c"), ("de", "only", None), ("it", "x", ""), ("it", "y", None), ("it", None, "rare")]
    rows += [("en", "s1", "hot words " * 50)] * 40
    expect = divergence_brute(rows, 3, 4)
    assert audited(spark, rows, min_docs=3, top=4) == expect
    # many blocks and slices, and runs that are sent every few rows, change nothing
    assert audited(spark, rows, min_docs=3, top=4, block=2, slice_rows=7, flush=20) == expect
    odd = [("en" if i % 2 else None, f"s{i % 3}", x) for i, (_, x) in enumerate(odd_rows())]
    assert audited(spark, odd) == divergence_brute(odd, 10, 10)
    assert audited(spark, []) == []


def test_share_is_exact():
    rng = random.Random(6)
    for _ in range(2000):
        total, kept = rng.randrange(10 ** rng.randrange(1, 15)), rng.randrange(1, 10 ** rng.randrange(1, 12))
        n = rng.randrange(total + 1)
        assert divergence.shares(np.array([n]), np.array([total]), kept)[0] == 1 + 10**9 * (n + 2) // (total + 2 * kept)


def print_brute(x):
    w = re.findall(r"[^\x20\x09-\x0D]+", (x or "").translate(LOWER))
    runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def classes_brute(keys, links):
    root = {k: k for k in keys}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {k: top(k) for k in keys}


def near_prints(prints, bits=3):
    p = np.array(sorted(prints), np.uint64)
    far = np.bitwise_count(p[:, None] ^ p)
    return [(int(p[i]), int(p[j])) for i, j in zip(*np.nonzero(far <= bits), strict=True) if i < j]


def test_golay_cover():
    c = simhash_cover.cover(3)
    rng = np.random.default_rng(1)
    p = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    at, anchor = c.anchors(p)
    words = np.arange(1 << 12, dtype=np.uint32) << 11
    words |= c.syndrome(words)
    assert min(np.bitwise_count(words[1:])) == 7
    block = [np.bitwise_count((p >> np.uint64(s) & np.uint64((1 << 23) - 1)).astype(np.uint32)[:, None] ^ words).astype(int) for s in (0, 23)]
    for i in range(len(p)):
        inside = {(int(a) << 12) | int(b) for a, b in zip(*np.nonzero(block[0][i][:, None] + block[1][i] <= 9), strict=True)}
        assert sorted(anchor[at == i].tolist()) == sorted(inside)
    assert (np.array([block[0][i][h >> 12] + block[1][i][h & 0xFFF] for i, h in enumerate(c.homes(p))]) <= 6).all()


def simhash_expect(rows):
    prints = [print_brute(x) for _, x in rows]
    root = classes_brute(set(prints), near_prints(set(prints)))
    low = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            low[root[p]] = min(i, low.get(root[p], i))
    return Counter((i, f"{p:016x}", low.get(root[p])) for (i, _), p in zip(rows, prints, strict=True))


def test_simhash(spark):
    rng = random.Random(8)
    base = " ".join(f"w{rng.randrange(300)}" for _ in range(400)).split()
    rows = odd_rows()
    for i in range(60):  # a crowd of near copies
        near = list(base)
        near[rng.randrange(400)] = f"Edit{i}"
        rows.append((2000 + i, "  ".join(near)))
    got = simhash_cover.near_duplicates(frame(spark, rows)).collect()
    expect = simhash_expect(rows)
    assert Counter(tuple(r) for r in got) == expect
    assert any(c != i for i, _, c in expect)
    assert simhash_cover.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("crowd", [65_536, 5])
def test_simhash_links(spark, crowd):
    """Chains and crowds of fingerprints, with crowded anchors dealt or not."""
    rng = random.Random(9)
    seeds = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    prints = set(seeds)
    for s in seeds:
        for _ in range(12):
            for _ in range(rng.randrange(1, 6)):
                s ^= 1 << rng.randrange(64)
            prints.add(s)
    hub = rng.getrandbits(64)
    prints |= {hub ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(46, 64)) ^ (1 << rng.randrange(46, 64)) for _ in range(200)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash_cover.links(spark.createDataFrame([(p,) for p in signed], "print long"), crowd=crowd).collect()
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in found]
    assert classes_brute(prints, pairs) == classes_brute(prints, near_prints(prints))


def near_brute(words):
    """Pairs at one edit, by deletion of every code point."""
    out, by = set(), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            less = w[:i] + w[i + 1 :]
            by[less, i].add(w)
            if less in words and less != w:
                out.add((less, w))
    for same in by.values():
        out |= {(a, b) for a in same for b in same if a != b}
    return out | {(b, a) for a, b in out}


def spelling_brute(rows, least=7, rare=2, ratio=10):
    n = Counter()
    for i, x in rows:
        for w in re.findall("[A-Za-z\u00C0-\u00FF]+", x or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            k = h % len(w)
            n[w[:k] + w[k + 1 :] if h % 31 == 0 else w] += 1
    n = {w: c for w, c in n.items() if len(w) >= least and c >= rare}
    near = defaultdict(list)
    for a, b in near_brute(n.keys()):
        near[a].append(b)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), c, len(near[w]), n[form[w]] if form[w] else 0) for w, c in n.items())


@pytest.mark.parametrize("crowd", [32, 2])
def test_spelling(spark, crowd):
    rng = random.Random(11)
    parts = ["ing", "ther", "é", "ß", "an", "AN", "Ø", "tion", "a", "aa", "\u00d7", "ÿÿ", "b"]
    base = ["".join(rng.choices(parts, k=rng.randrange(2, 6))) for _ in range(120)] + ["a" * k for k in range(6, 14)] + ["abcdefgh", "abcdefg", "x" * 300, "x" * 301]
    rows = []
    for i in range(300):
        words = rng.choices(base, weights=[1 + 400 // (j + 1) for j in range(len(base))], k=rng.randrange(0, 60))
        if rng.random() < 0.5:
            words = [w[:j] + rng.choice(["", "q", w[j : j + 1] * 2]) + w[j + 1 :] for w in words for j in [rng.randrange(len(w))]]
        rows.append((i, rng.choice([" ", "-", "中", "\n", "1"]).join(words)))
    rows += odd_rows() + [(None, "abcdefgh " * 40), (7, "É" * 9 + "\u0100" + "Abcdefgh")]
    got = spelling.group_variants(frame(spark, rows), crowd=crowd).collect()
    expect = spelling_brute(rows)
    assert sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in got) == expect
    assert sum(1 for x in expect if x[1]) > 20 and any(x[1] and x[1] != x[2] for x in expect)
    assert spelling.group_variants(frame(spark, [])).count() == 0


def test_checksums():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    starts = rng.integers(0, 4000, 400)
    size = rng.choice([0, 1, 5, 8, 63, 64, 65, 300], 400)
    before = rng.integers(0, 1 << 32, 400, dtype=np.uint32)
    got = spelling.checksums(data, starts, size, before)
    assert [int(x) for x in got] == [zlib.crc32(data[a : a + n].tobytes(), int(c)) for a, n, c in zip(starts, size, before, strict=True)]
