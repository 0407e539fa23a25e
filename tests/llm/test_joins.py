"""Substring dedup, similarity join, sharding, packing, classifier and the
pipeline against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from parcelflow.llm import fm_dedup, fm_index, frames, line_crf, partition_join, pseudonyms, queries, secret_scan, tiling, vector_packing, window_packing, window_tokens
from parcelflow.llm.frames import components
from tests.llm.helpers import frame, odd_rows, prose

DATA = "/root/testdata/sf0.001"


def dedup_brute(rows, window):
    first = {}
    texts = [(i, (x or "").encode().split()) for i, x in rows]
    for i, w in texts:
        for k in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, w in texts:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = True
        out[i, len(w), int(gone.sum()), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()] += 1
    return out


@pytest.mark.parametrize("crowded,shard_words", [(2000, 400_000), (1, 300)])
def test_substring_dedup(spark, crowded, shard_words):
    rows = odd_rows()
    got = fm_dedup.dedup_windows(frame(spark, rows), crowded=crowded, shard_words=shard_words).collect()
    assert Counter(tuple(r) for r in got) == dedup_brute(rows, 50)
    assert sum(r.n_removed for r in got) > 500


def test_matching_statistics_decide(spark, monkeypatch):
    """Where the backward search finds nothing, nothing is removed: not from
    exact copies, nor inside shared passages or crowded windows."""
    found, rows = fm_dedup.search_shard, odd_rows()
    none = F.array().cast("array<struct<s:int,e:int>>")
    for crowded in (fm_dedup.CROWDED, 3):
        assert sum(r.n_removed for r in fm_dedup.dedup_windows(frame(spark, rows), crowded=crowded).collect()) > 1000
        monkeypatch.setattr(fm_dedup, "search_shard", lambda *a: found(*a).withColumns({"spans": none, "found": none}))
        assert sum(r.n_removed for r in fm_dedup.dedup_windows(frame(spark, rows), crowded=crowded).collect()) == 0
        monkeypatch.setattr(fm_dedup, "search_shard", found)


def test_substring_dedup_empty(spark):
    assert fm_dedup.dedup_windows(frame(spark, [])).count() == 0


def test_index_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(40):
        t = int(rng.integers(1, 8))
        docs, streams = ([rng.integers(0, 3, rng.integers(0, 30)) for _ in range(5)] for _ in range(2))
        first = np.concatenate([[0], np.cumsum([len(x) for x in docs])])
        index = fm_index.FMIndex(np.concatenate(docs), first, t)
        begin = np.concatenate([[0], np.cumsum([len(x) for x in streams])])
        words = np.concatenate(streams)
        words[rng.random(len(words)) < 0.1] = -1
        got, low = index.matches(words, begin), index.group_minimum(np.arange(5) * 10)
        where = {}
        for i, d in enumerate(docs):
            for p in range(len(d) - t + 1):
                where.setdefault(tuple(d[p : p + t]), i * 10)
        for a, b in zip(begin[:-1], begin[1:], strict=True):
            for p in range(a, b):
                expect = where.get(tuple(words[p : p + t])) if p + t <= b else None
                assert (low[got[p]] if got[p] >= 0 else None) == expect


def join_brute(rows, shingle, percent):
    sets = defaultdict(list)
    for i, x in rows:
        if i is not None and (s := partition_join.shingle_set(x, shingle)):
            sets[i].append(s)
    parent = {i: i for i, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[:a]:
            if any(100 * len(x & y) >= percent * len(x | y) for x in sets[i] for y in sets[j]):
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return Counter((i, len(partition_join.shingle_set(x, shingle)), None if i is None else root(i)) for i, x in rows)


@pytest.mark.parametrize("shingle,percent,per_row,block", [(3, 90, 4, 2000), (5, 80, 0.1, 3)])
def test_similarity_join(spark, monkeypatch, shingle, percent, per_row, block):
    monkeypatch.setattr(partition_join, "PAIRS_PER_ROW", per_row)
    monkeypatch.setattr(partition_join, "BLOCK_SETS", block)
    rng = random.Random(4)
    base = prose(rng, 60).split()
    rows = odd_rows()
    for i in range(25):  # a chain of copies, each further from the first
        base[rng.randrange(60)] = f"n{i}"
        rows.append((900 + i, " ".join(base)))
    got = partition_join.similarity_components(frame(spark, rows), shingle, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == join_brute(rows, shingle, percent)


def test_strangers_in_crowded_buckets_stay_apart(spark, monkeypatch):
    """Texts that share only a passage meet in buckets and chain through them;
    neither their sets nor their texts are moved for it, and no link is lost."""
    monkeypatch.setattr(partition_join, "PAIRS_PER_ROW", 0.1)
    rows_of = {}

    def staged(df, name, stage=partition_join.staged):
        out = stage(df, name)
        rows_of[name] = rows_of.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(partition_join, "staged", staged)
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(150):
        own = [f"d{i}x{j}" for j in range(40)]
        rows.append((i, " ".join(passage + own)))
        if i % 15 == 0:  # with a near copy, and one that is near only to that
            for k in (1, 2):
                own[rng.randrange(40)] = f"e{i}k{k}"
                rows.append((1000 * k + i, " ".join(passage[3 * k :] + own)))
    got = partition_join.similarity_components(frame(spark, rows), 5, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == join_brute(rows, 5, 80)
    assert rows_of["open"] > 300  # they do meet
    assert rows_of["crowds"] <= 30 and rows_of["verify-texts"] <= 60


def test_sketches_lose_no_pair():
    """Sets within the bound are likely and in one group, also where sketches of
    different widths meet, and where a chain of blocks connects them."""
    rng = np.random.default_rng(12)
    for percent, sizes in ((80, (1, 4, 30)), (80, (288, 300, 320)), (90, (330, 340, 420)), (80, (2400, 2500))):
        bands = partition_join.Bands(percent)
        sets = []
        for size in sizes:
            base = rng.integers(0, 1 << 52, size * 2, dtype=np.uint64)
            for _ in range(12):  # a window of the base, its ends anywhere
                a = int(rng.integers(0, max(1, size // 3)))
                sets.append(np.unique(base[a : a + size + int(rng.integers(0, max(1, size // 4)))]))
        n = np.array([len(x) for x in sets])
        marks = partition_join._sketches(np.concatenate(sets), np.repeat(np.arange(len(sets)), n), n, bands).to_pylist()
        comp = np.arange(len(sets))
        comp[1] = comp[0]
        words = partition_join._folded(marks)
        for step in (1 << 21, 40):
            partition_join.SKETCH_WORDS, kept = step, partition_join.SKETCH_WORDS
            head = partition_join.likely_groups(n, comp, marks, bands)
            partition_join.SKETCH_WORDS = kept
            for i in range(len(sets)):
                for j in range(i):
                    both = len(np.intersect1d(sets[i], sets[j]))
                    if 100 * both >= percent * (n[i] + n[j] - both):
                        assert np.bitwise_count(words[i] ^ words[j]).sum() <= bands.differ(n[i] + n[j])
                        assert comp[i] == comp[j] or head[i] == head[j]
        assert len(set(head.tolist())) >= len(sizes)  # strangers stay apart


def test_stage_tables_leave_no_shuffle_files(spark, monkeypatch):
    """The setting holds while a table is written and is put back."""
    seen = []
    monkeypatch.setattr(frames, "stage_table", lambda df, name: seen.append(spark.conf.get(frames.SHUFFLE_CLEANUP)) or df)
    before = spark.conf.get(frames.SHUFFLE_CLEANUP)
    frames.staged(spark.range(1), "x")
    assert seen == ["true"] and spark.conf.get(frames.SHUFFLE_CLEANUP) == before


def test_similarity_join_counts_no_links(spark):
    """Links are made only as far as components need them: no column counts them."""
    base = prose(random.Random(5), 200)
    got = partition_join.similarity_components(frame(spark, [(i, f"{base} end{i}") for i in range(3)]))
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and {r.component_id for r in got.collect()} == {0}


def test_similarity_join_empty(spark):
    assert partition_join.similarity_components(frame(spark, [])).count() == 0


@pytest.mark.parametrize("far", [[], [(1 << 63) - 1], [(1 << 63) - 1, -(1 << 63)]])
def test_keep_one_judges_rows(spark, far):
    """Repeated, conflicting and null ids: one row a component, by id."""
    rng = random.Random(8)
    a, b, c, d, e, f = (prose(rng, 80) for _ in range(6))
    rows = [(5, a)] * 40 + [(None, a)] * 3  # a repeated row and copies without an id
    rows += [(None, b)] * 4 + [(None, None), (None, ""), (None, "")]
    rows += [(3, c), (7, c + " tail"), (7, d)]  # an id with a near and a clean text
    rows += [(9, e), (9, e + " end"), (8, e)] + [(11, f)] + [(100 + i, prose(rng, 60)) for i in range(5)]
    rows += [(i, prose(rng, 60)) for i in far]
    rng.shuffle(rows)
    got = partition_join.keep_one(frame(spark, rows))
    assert got.schema.names == frame(spark, rows).schema.names
    kept = [(5, a), (None, b), (None, None), (None, ""), (None, ""), (3, c), (7, d), (8, e), (11, f)] + [r for r in rows if r[0] and (r[0] >= 100 or r[0] < 0)]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(kept)


def test_keep_one_odd_rows(spark):
    """Rows as nodes against brute force."""
    rows = odd_rows()
    best = {}
    for (i, x), ((node, n, comp), _) in zip(rows, sorted(join_brute(list(enumerate(x for _, x in rows)), 5, 80).items()), strict=True):
        key = comp if n else ("alone", node)
        best[key] = min(best.get(key, (True, 0)), (i is None, i or 0))
    got = Counter((r.doc_id is None, r.doc_id or 0) for r in partition_join.keep_one(frame(spark, rows)).collect())
    assert got == Counter(best.values())


@pytest.mark.parametrize("crowd", [1, 3, 40])
def test_signatures_miss_no_pair(crowd):
    """Pairs within the bound share a signature at every size, for any costs,
    also where the elements crowd into few segments."""
    rng = np.random.default_rng(9)
    tried = 0
    for percent in (50, 80, 90):
        bands = partition_join.Bands(percent)
        for _ in range(1500):
            n = int(rng.integers(2, 120 if rng.random() < 0.9 else 1500))
            spots = rng.integers(0, 1 << 52, int(rng.integers(1, crowd + 1)), dtype=np.uint64) if crowd > 1 else None

            def some(count, spots=spots):
                free = rng.integers(0, 1 << 52, count, dtype=np.uint64)
                return free if spots is None else np.where(rng.random(count) < 0.1, free, rng.choice(spots, count) ^ (free >> np.uint64(16)))

            x = np.unique(some(n))
            limit = bands.differ(2 * len(x)) + 1
            drop = int(rng.integers(0, limit + 1))
            y = np.unique(np.concatenate([rng.permutation(x)[drop:], some(int(rng.integers(0, limit - drop + 1)))]))
            both = len(np.intersect1d(x, y))
            if both and 100 * both >= percent * (len(x) + len(y) - both) and both < max(len(x), len(y)):
                tried += 1
                costs = rng.integers(0, 9, partition_join.SLOTS).astype(float)
                doc, sig = partition_join.signatures(np.concatenate([x, y]), np.repeat([0, 1], [len(x), len(y)]), np.array([len(x), len(y)]), bands, costs)
                assert set(sig[doc == 0]) & set(sig[doc == 1]), (percent, len(x), len(y), both)
    assert tried > 1000


def test_neighbourhoods_pay_for_empty_parts():
    """A set indexes its parts and, for each empty one, the neighbourhood of one
    part, the cheapest first."""
    rng = np.random.default_rng(2)
    bands = partition_join.Bands(80)
    sets = [np.unique(rng.integers(0, 1 << 52, int(n), dtype=np.uint64)) for n in rng.integers(20, 900, 200)]
    element, n = np.concatenate(sets), np.array([len(x) for x in sets])
    parts = partition_join.Parts(element, np.repeat(np.arange(len(sets)), n), n, bands, 0)
    costs = rng.random(partition_join.SLOTS)
    marks = parts.allocated(bands, costs)
    assert (np.bincount(parts.doc[marks], minlength=len(n)) == parts.empty).all() and parts.empty.sum() > 100
    price, late = costs[parts.slot()], parts.segment >= bands.common(parts.k[parts.doc])
    for i in np.flatnonzero(parts.empty):
        own = (parts.doc == i) & (parts.size > 1) & ~late
        if (own & ~marks).any() and (own & marks).any():
            assert price[own & marks].max() <= price[own & ~marks].min()


def test_costs_count_all_signatures(spark):
    """A segment that many different sets fill alike costs more."""
    rng = random.Random(3)
    assert (partition_join.segment_costs(frame(spark, []), 5, 80) == 0).all()
    alone = partition_join.segment_costs(frame(spark, [(i, prose(rng, 60)) for i in range(20)]), 5, 80)
    base = prose(rng, 60)
    alike = partition_join.segment_costs(frame(spark, [(i, f"{base} end{i}") for i in range(20)] + [(None, base)]), 5, 80)
    assert alike.sum() > 2 * alone.sum() > 0


def test_components(spark):
    links = [(1, 2), (3, 2), (4, 3), (10, 11), (7, 7), (11, 10)] + [(20 + i, 21 + i) for i in range(30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10} | {20 + i: 20 for i in range(31)}


@pytest.mark.parametrize("name", ["op4_fm_dedup", "op7_partition_join"])
def test_oracles(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    got = queries.QUERIES[name](spark, DATA)
    expect = con.sql(queries.ORACLE[name])
    assert Counter(tuple(r) for r in got.select(*expect.columns).collect()) == Counter(expect.fetchall())


def test_shards(spark):
    rows = odd_rows() + [(5000 + i, "hot copy of a text") for i in range(400)]
    got = vector_packing.assign_shards(frame(spark, rows), shards=8).collect()
    size = Counter((i, len((x or "").encode()) + 16, zlib.crc32((x or "").encode())) for i, x in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == size
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in got if r.text_crc32 == zlib.crc32(b"hot copy of a text")}) > 1  # a hot group is split
    assert vector_packing.assign_shards(frame(spark, [])).count() == 0


def test_shards_against_plain_placing(spark):
    """One block of groups that differ in size: the shards hold what plain
    dot-product placing, largest first, puts together."""
    rng = random.Random(21)
    sizes = rng.sample(range(1500, 2300), 400)
    texts = [("w" * rng.randrange(4, 7) + " ") * n for n in sizes]
    texts = [x[:n] for x, n in zip(texts, sizes, strict=True)]
    copies = [1] * len(texts)
    rows = [(i * 10 + k, x) for i, (x, c) in enumerate(zip(texts, copies, strict=True)) for k in range(c)]
    got = defaultdict(set)
    for r in vector_packing.assign_shards(frame(spark, rows), shards=4, blocks=1).collect():
        got[r.shard].add(r.doc_id)
    groups = [(c * (len(x) + 16), c * (x.count(" ") + 1), c, [i * 10 + k for k in range(c)]) for i, (x, c) in enumerate(zip(texts, copies, strict=True))]
    assert len({g[0] for g in groups}) > 380 and max(g[0] for g in groups) * 200 < sum(g[0] for g in groups)
    order = sorted(groups, key=lambda g: -g[0])
    total = [sum(g[d] for g in groups) for d in range(3)]
    left, held = [[1.0] * 3 for _ in range(4)], [set() for _ in range(4)]
    for g in order:
        v = [g[d] * 4 / total[d] for d in range(3)]
        fits = [b for b in range(4) if all(left[b][d] >= v[d] for d in range(3))]
        at = max(fits, key=lambda b: sum(x * y for x, y in zip(left[b], v, strict=True))) if fits else max(range(4), key=lambda b: left[b][0])
        left[at] = [x - y for x, y in zip(left[at], v, strict=True)]
        held[at] |= set(g[3])
    same = sum(len(max((a & b for b in held), key=len)) for a in got.values())
    assert same >= 0.9 * len(rows)  # ties and the last bit of a product may go another way


def test_shards_are_near_equal(spark):
    got = queries.QUERIES["op5_vector_packing"](spark, "/root/testdata/sf0.01").groupBy("shard").sum("size").collect()
    sizes = [r["sum(size)"] for r in got]
    assert len(sizes) == 40 and max(sizes) < 1.15 * min(sizes)


def plain_best_fit(lengths, window):
    """Best-fit decreasing, one piece at a time; the sorted fills."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
        room.append((min(fits) if fits else window) - n)
    return sorted(window - r for r in room)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(6)
    for _ in range(60):
        window = rng.choice([16, 33, 64])
        lengths = [rng.randint(1, window) for _ in range(rng.randrange(1, 120))]
        plan = window_packing.plan_windows(Counter(lengths), window)
        fill, seen = Counter(), defaultdict(set)
        for n, c in Counter(lengths).items():
            rows = plan[plan[:, 0] == n]
            for rank in range(c):
                _, lo, first, each, off = rows[np.searchsorted(rows[:, 1], rank, "right") - 1]
                seq, at = first + (rank - lo) // each, off + (rank - lo) % each * n
                assert not seen[seq] & set(range(at, at + n)) and at + n <= window
                seen[seq] |= set(range(at, at + n))
                fill[seq] += n
        assert all(s == set(range(len(s))) for s in seen.values())
        assert sorted(fill.values()) == plain_best_fit(lengths, window)


def test_packing_round_trip(spark):
    path = public_tokenizers.path(window_packing.VOCABULARY)
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    rows = odd_rows()
    got = window_packing.pack(frame(spark, rows), path, window=512).collect()
    expect = Counter()
    for i, x in rows:
        ids = np.array([*tok.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        for a in range(0, len(ids), 512):
            expect[i, a, len(ids[a : a + 512]), zlib.crc32(ids[a : a + 512].tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == expect
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        end = 0
        for off, n in sorted(places):
            assert off == end
            end += n
        assert end <= 512
    assert window_packing.pack(frame(spark, []), path).count() == 0


def test_special_strings_follow_the_plain_call(spark):
    """Ids equal those of a tokenizer as it comes from its file, also where a
    text has the strings of special tokens."""
    path = public_tokenizers.path(window_packing.VOCABULARY)
    plain = Tokenizer.from_file(path)
    special = [t.content for t in plain.get_added_tokens_decoder().values()]
    assert special
    rng = random.Random(1)
    texts = [f"a {x} b" for x in special] + [x.upper() + x for x in special] + [f"{special[-1]}{special[0]}", "a <|endoftext", "<|", "plain words", ""]
    texts += [" ".join(rng.choices([*special, "word", "Straße", "é", "中"], k=rng.randrange(1, 20))) for _ in range(300)]
    want = [plain.encode(x, add_special_tokens=False).ids for x in texts]
    for cache in (1_000_000, 20):
        ids, n = window_tokens.CachedTokenizer(path, cache).encode(texts)
        assert [p.tolist() for p in np.split(ids, np.cumsum(n)[:-1])] == want
    got = {r.doc_id: (r.ids_crc32, r.doc_tokens) for r in window_packing.pack(frame(spark, list(enumerate(texts))), path).collect()}
    assert got == {i: (zlib.crc32(np.array([*w, 2], "<u4").tobytes()), len(w) + 1) for i, w in enumerate(want)}


def test_cached_tokens_equal_the_tokenizer():
    rng = random.Random(0)
    bits = [chr(c) for c in range(0x250)] + ["'s", "'re", "'ll", " ", "\n", "''", "don't", "İ", "Σ", "ß", "é", "中", "<|endoftext|>"] * 20
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 60))) for _ in range(1500)] + ["", "\0"]
    for cache in (1_000_000, 100):
        tok = window_tokens.CachedTokenizer(public_tokenizers.path(window_packing.VOCABULARY), cache)
        ids, n = tok.encode(texts)
        parts = np.split(ids, np.cumsum(n)[:-1])
        assert all(p.tolist() == tok.whole.encode(x, add_special_tokens=False).ids for p, x in zip(parts, texts, strict=True))


def chain_brute(model, x):
    """Marginals by summing over all labelings."""
    n, total, good = len(x), 0.0, np.zeros(len(x))
    for m in range(1 << n):
        y = [m >> t & 1 for t in range(n)]
        p = np.exp(sum(y[t] * (x[t] @ model.weights) for t in range(n)) + sum(model.transition[y[t - 1], y[t]] for t in range(1, n)))
        total += p
        good += p * np.array(y)
    return good / total


def test_marginals_against_all_labelings():
    rng = np.random.default_rng(2)
    sizes = [1, 4, 7, 2]
    x = rng.normal(size=(sum(sizes), 5))
    model = line_crf.Crf(rng.normal(size=5), rng.normal(size=(2, 2)))
    first = np.concatenate([[0], np.cumsum(sizes)])
    got, _ = model.marginals(x, first)
    for a, b in zip(first[:-1], first[1:], strict=True):
        assert np.allclose(got[a:b], chain_brute(model, x[a:b]))


def test_line_features_do_not_mix_texts():
    texts = ["a b\nc c\n", "", None, "\n\n", "A!! B##\nx"]
    x, size, first = line_crf.line_features(pa.array(texts, pa.string()))
    assert np.diff(first).tolist() == [3, 1, 1, 3, 2]
    for i, t in enumerate(texts):
        alone, own, _ = line_crf.line_features(pa.array([t], pa.string()))
        assert np.allclose(alone, x[first[i] : first[i + 1]]) and np.allclose(own, size[first[i] : first[i + 1]])


def test_classifier_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = queries.QUERIES["op10_line_crf"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in got)
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


def test_classifier_odd_rows(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for labels, score in ((none, 0.5), (spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0), (3, 1, 0)], none.schema), 1.0)):
        model = line_crf.train(docs, labels)
        got = line_crf.score_documents(docs, model).collect()
        assert len(got) == len(rows) and {r.score for r in got} == {score}
    both = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], none.schema)
    got = line_crf.score_documents(docs, line_crf.train(docs, both)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows) and all(0 <= r.score <= 1 for r in got)
    assert line_crf.keep_good(docs, 0.5).schema == docs.schema and line_crf.keep_good(docs, 0.1).count() == 0


def test_classifier_trains_on_all_lines(spark, monkeypatch):
    """Bad lines that come after a hundred good ones teach the model; the
    bound on lines leaves out documents, not parts of them."""
    rng = random.Random(3)

    def text(bad):
        lines = [prose(rng, 8) for _ in range(100)]
        return "\n".join(lines + (["$$ ## !! 123 @@ ||"] * 60 if bad else [prose(rng, 8) for _ in range(60)]))

    docs = frame(spark, [(i, text(i % 2)) for i in range(40)])
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    seen = []

    def spy(x, size, first, label, share, fit=line_crf.fit):
        seen.append((np.diff(first).tolist(), label.tolist()))
        return fit(x, size, first, label, share)

    monkeypatch.setattr(line_crf, "fit", spy)
    got = line_crf.score_documents(docs, line_crf.train(docs, labels)).collect()
    assert len(got) == 40 and all(r.predicted == 1 - r.doc_id % 2 for r in got) and set(seen[0][0]) == {160}
    line_crf.train(docs, labels, train_lines=500)
    assert seen[1][0] == [160] * 8 and sum(seen[1][1]) == 4  # four of a class reach 500 lines
    monkeypatch.setattr(line_crf, "CHAIN_LINES", 30)
    got = line_crf.score_documents(docs, line_crf.train(docs, labels)).collect()
    assert all(r.predicted == 1 - r.doc_id % 2 for r in got)


def test_lines_are_learnt_from_document_labels():
    """Documents of 100 good and 60 bad lines, labelled bad as a whole: the
    marginals split where the lines change, also in blocks and at either end."""
    rng = random.Random(4)
    good = lambda n: [prose(rng, rng.randrange(5, 12)) for _ in range(n)]
    bad = lambda n: ["$$ ## !! 123 @@ ||"] * (n // 2) + ["".join(rng.choices("!?#%&123 |", k=40)) for _ in range(n - n // 2)]
    texts = [good(160) if i % 2 else good(100) + bad(60) if i % 4 else bad(60) + good(100) for i in range(40)]
    x, size, first = line_crf.line_features(pa.array(["\n".join(t) for t in texts]))
    model = line_crf.fit(x, size, first, np.arange(40) % 2.0, 0.5)
    for lines in ([(100, 1), (60, 0)], [(60, 0), (100, 1)], [(50, 1), (30, 0), (50, 1), (30, 0)], [(160, 1)], [(160, 0)]):
        text = [line for n, y in lines for line in (good(n) if y else bad(n))]
        want = np.concatenate([np.full(n, y) for n, y in lines])
        x, _, first = line_crf.line_features(pa.array(["\n".join(text)]))
        got, _ = model.marginals(x, first)
        assert ((got > 0.5) == want).mean() >= 0.97, (lines, got.round(2).tolist())


def test_training_lines_are_bounded(spark):
    """A text of a million lines is left out before its features are made."""
    docs = frame(spark, [(i, "ok words here\n" * 3 if i % 2 else "!! ## $$") for i in range(20)] + [(21, "x\n" * 1_000_000)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(22)], "doc_id long, quality int, toxic int")
    got = line_crf.score_documents(docs.where("doc_id < 20"), line_crf.train(docs, labels)).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)


def test_pipeline(spark):
    """Each stage against a plain version over its own input."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, DATA).cache()
    score = {r.doc_id: r.predicted for r in queries.QUERIES["op10_line_crf"](spark, DATA).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, p in score.items() if p}
    one = stages["near_duplicates"](spark, good, DATA).cache()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert {r.doc_id for r in one.collect()} == {i for i, _, c in join_brute(rows, 5, 80) if i == c}
    clean = stages["decontamination"](spark, one, DATA).cache()
    items = [set(zip(*(w[k:] for k in range(len(w))), strict=False)) and w for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect() if (w := r.text.lower().split())]
    leaked = {r.doc_id for r in one.collect() if any(" ".join(w) in " ".join(r.text.lower().split()) for w in items)}
    assert leaked and not leaked & {r.doc_id for r in clean.collect()} and one.count() - clean.count() <= len(leaked) + 2
    safe = stages["secrets"](spark, clean, DATA).cache()
    assert safe.schema.names == docs.schema.names and safe.count() == clean.count() and all(r.n_chars == len(r.text) for r in safe.collect())
    packed = stages["packing"](spark, safe, DATA).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in safe.collect()}
    assert Counter(map(tuple, corpus_pipeline.run(spark, DATA).select("doc_id", "start", "ids_crc32").collect())) == Counter((r.doc_id, r.start, r.ids_crc32) for r in packed)


def test_clashing_names(spark):
    """Columns named like the helpers of a stage are kept as they are."""
    rng = random.Random(8)
    a, b = prose(rng, 60), prose(rng, 60)
    names = ["_several", "_GONE", "_keep_node", "_leak_key", "_leak_key1", "c", "node", "hash", "item_id", "one"]
    docs = spark.createDataFrame([(i, x, *[k] * len(names)) for k, (i, x) in enumerate([(1, a), (2, a), (3, b), (3, b), (None, a), (4, None)])],
                                 "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    kept = partition_join.keep_one(docs)
    assert kept.schema.names == docs.schema.names and sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(1, a), (3, b), (4, "")]
    bench = spark.createDataFrame([(7, b)], "item_id long, text string")
    for most in (tiling.BROADCAST_BYTES, 0):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(tiling, "BROADCAST_BYTES", most)
            clean = tiling.decontaminate(docs, bench)
            assert clean.schema.names == docs.schema.names and sorted(str(r.doc_id) for r in clean.collect()) == ["1", "2", "4", "None"]


def test_stages_on_empty_tables(spark):
    empty = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = line_crf.train(empty, labels)
    assert line_crf.score_documents(empty, model).count() == 0 and line_crf.keep_good(empty, model).count() == 0
    assert partition_join.keep_one(empty).count() == 0 and secret_scan.redact_secrets(empty).count() == 0
    assert pseudonyms.pseudonymise(empty, b"test key").count() == 0


def _corpus(spark, folder, rows, labels):
    kind = "doc_id long, text string, lang string, source string, n_chars long, _gone int, score double"
    spark.createDataFrame([(i, x, "en", None, None if x is None else len(x), 1, 2.0) for i, x in rows], kind).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, prose(random.Random(77), 30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_pipeline_odd_tables(spark, tmp_path):
    """Nulls, repeated and missing ids, clashing names; then an empty table."""
    rng = random.Random(5)
    a, leak = prose(rng, 90), prose(random.Random(77), 30)
    rows = [(1, a), (2, a), (None, a), (3, None), (4, ""), (5, "password = hunter2secret"), (6, leak + " more"), (7, prose(rng, 50)), (7, prose(rng, 50))]
    folder = _corpus(spark, str(tmp_path / "odd"), rows, [])
    packed = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in packed) == [1, 3, 4, 5, 7, 7]
    assert {r.doc_id: r.doc_tokens for r in packed if r.doc_id in (3, 4)} == {3: 1, 4: 1}
    assert corpus_pipeline.run(spark, _corpus(spark, str(tmp_path / "none"), [], [])).count() == 0
