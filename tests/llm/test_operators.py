"""The text operators against brute force, and on nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash

from terragrid.llm import bigru, bloom_lm, bpe, common, decontamination, gbt_quality, near_copies, packing, quality_rules, sharding, simhash, token_counts, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, fp long, cell string"
PROSE = "the quick brown fox jumps over the lazy dog and then runs far away from all of the noisy hounds."


def rows_of(*texts):
    return [(i, t, "en" if i % 2 else "fr", "s", 0, 1, 2, "c") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, clashing columns."""
    rows = rows_of(None, "", " \n\t ", PROSE, PROSE, "x" * 3_000_000, "é ß <|endoftext|> 漢字\u0085  word's", "a b", PROSE.replace("quick", "slow"), "12345 67 !!")
    rows += [rows[3], (None, PROSE, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(10)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")


def test_language_learns_and_handles_odd_rows(spark, odd, none):
    rng = np.random.default_rng(1)
    words = {"aa": "alpha banana arcada data".split(), "zz": "zzyx quux wyx zigzug".split()}
    rows = [(i, " ".join(rng.choice(words[k], 12)), k) for i in range(160) for k in [("aa", "zz")[i % 2]]]
    got = bigru.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rounds=60).collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == ("aa", "zz")[r.doc_id % 2] for r in held]) > 0.95
    got = bigru.language_id(odd, rounds=3).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (0, 1, 2, 9)} == {"und"}
    assert bigru.language_id(none, rounds=3).count() == 0


def test_training_reads_whole_texts_within_its_bounds():
    raw = [b"a" * 100, b"", b"b" * bigru.STEPS, bytes(range(1, 200)) * 50_000]
    codes, owner, lengths = bigru.windows_of(raw)
    for i, x in enumerate(raw):
        assert b"".join(bytes(c[:n].astype(np.uint8)) for c, n in zip(codes[owner == i], lengths[owner == i], strict=True)) == x
    assert bigru.fitting([5, 9, 3, 3, 0, 2], 10) == [0, 2, 4, 5]
    assert bigru.fitting([], 10) == bigru.fitting([1], 0) == []


def test_language_training_counts_repeated_rows_once(spark):
    rows = [(1, "der die das und", "de")] * 300 + [(1, "the of and to", "en"), (3, "the and a of", "en"), (4, "", "de"), (6, "x " * 4000, "fr"), (5, "held out", "es")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    assert bigru.learn(docs, rounds=1, most=100).labels == ["de", "en"]  # the long text does not fit
    assert bigru.learn(docs, rounds=1).labels == ["de", "en", "fr"]
    assert bigru.learn(docs, docs_bound=0, rounds=1).labels == []


def test_network_gradients_match_differences():
    net = bigru.BiGru(["a", "b", "c"], state=3)
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    codes = np.random.default_rng(0).integers(97, 100, (2, 5)).astype(np.int16)
    codes[1, 3:] = bigru.PAD
    target = np.array([0, 2])
    _, g = net.train_step(codes, target)
    for k, at in (("E", (1, 98, 4)), ("U", (0, 1, 7)), ("U", (1, 2, 2)), ("W", (4, 1)), ("b", (2,))):
        keep = net.p[k][at]
        loss = []
        for e in (1e-3, -1e-3):
            net.p[k][at] = keep + e
            loss.append(net.train_step(codes, target)[0])
        net.p[k][at] = keep
        assert abs((loss[0] - loss[1]) / 2e-3 - g[k][at]) < 1e-4


def library_ids(texts):
    return [x.ids for x in bpe.tokenizer(bpe.vocabulary_path()).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_counts_are_the_librarys(spark, odd, none):
    got = token_counts.token_counts(odd).collect()
    want = [len(x) for x in library_ids([r.text for r in odd.collect()])]
    assert [r.n_tokens for r in got] == want
    assert all(r.over_limit == (r.n_tokens > 1024) and r.n_bytes == len((t or "").encode()) for r, t in zip(got, [r.text for r in odd.collect()], strict=True))
    assert token_counts.token_counts(none).count() == 0


def test_token_counts_do_not_depend_on_the_table(spark, odd):
    a, b = (token_counts.token_counts(odd, **k).collect() for k in ({"entries": 1}, {}))
    assert a == b


def test_frequent_table_covers_all_documents(spark):
    rows = [(i, f"often w{i} " * 3 + "z" * 100) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    table = token_counts.frequent_table(docs, bpe.vocabulary_path(), entries=4, fan_in=2).as_dict()
    assert len(table) <= 4 and " often" in table and all(len(k) <= bpe.CACHE_CHARS for k in table)
    assert all(n == len(library_ids([k])[0]) for k, n in table.items())
    assert token_counts.frequent_table(docs.limit(0), bpe.vocabulary_path()).as_dict() == {}


def test_pieces_survive_a_full_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    texts = [PROSE, PROSE.upper(), "tabs\t\tand   spaces \n\n end"]
    pieces = bpe.Pieces(bpe.vocabulary_path())
    assert [np.frombuffer(bpe.encode_ids(t, pieces), "<u4").tolist() for t in texts] == library_ids(texts)


def check_packing(docs, pieces, tokens=2048):
    ids = [x + [1] for x in library_ids([r.text for r in docs])]
    by_seq = {}
    for p in pieces:
        by_seq.setdefault(p.sequence_id, []).append(p)
    padding = 0
    for own in by_seq.values():
        own.sort(key=lambda p: p.offset)
        at = 0
        for p in own:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= tokens
        padding += 0 if at & (at - 1) == 0 else tokens - at
    assert sum(p.length for p in pieces) == sum(map(len, ids))
    return padding


def test_packing_covers_every_id_once(spark, odd, none):
    docs, pieces = odd.collect(), packing.pack_documents(odd).collect()
    assert check_packing(docs, pieces) == 0
    for doc in range(3, 10):
        own = library_ids([docs[doc].text])[0] + [1]
        mine = sorted((p.start, p.length, p.ids_crc32) for p in pieces if p.doc_id == doc)
        at = 0
        for start, length, crc in mine if doc != 3 else []:
            assert start == at and crc == zlib.crc32(np.asarray(own[start : start + length], "<u4").tobytes())
            at += length
        assert doc == 3 or at == len(own)
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize(("segments", "loss"), [(3, 2048), (512, 500), (1, 2048)])
def test_packing_keeps_every_limit_to_the_end(spark, odd, segments, loss):
    docs = odd.unionByName(odd).repartition(3)
    pieces = packing.pack_documents(docs, segments=segments, loss=loss).collect()
    assert check_packing(docs.collect(), pieces) == 0
    own = Counter(p.sequence_id for p in pieces)
    size = Counter()
    for p in pieces:
        size[p.sequence_id] += p.length
    assert max(own.values()) <= segments and max(size.values()) <= loss


def test_conversations_bear_loss_on_the_assistants_turns(spark):
    turns = [(c, t, "assistant" if t % 2 else "user", f"turn {t} of {c} " + PROSE * (1 + (c * t) % 3)) for c in range(60) for t in range(1 + c % 5)]
    turns += [(900, 0, None, None), (901, 0, "assistant", PROSE * 60)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(3)
    got = packing.pack_conversations(frame, tokens=256, segments=6, loss=100).collect()
    ids, loss = {}, {}
    for c, _, role, text in sorted(turns, key=lambda x: x[:2]):
        own = [*library_ids([text])[0], 1]
        ids.setdefault(c, []).extend(own)
        loss.setdefault(c, []).extend([role == "assistant"] * len(own))
    used = {}
    for p in got:
        mine = ids[p.doc_id][p.start : p.start + p.length]
        assert p.doc_tokens == len(ids[p.doc_id]) and p.ids_crc32 == zlib.crc32(np.asarray(mine, "<u4").tobytes())
        used.setdefault(p.sequence_id, []).append((p.offset, p.length, sum(loss[p.doc_id][p.start : p.start + p.length])))
    for own in used.values():
        own.sort()
        assert [o for o, _, _ in own] == [0, *np.cumsum([n for _, n, _ in own])[:-1]] and len(own) <= 6
        size = sum(n for _, n, _ in own)
        assert sum(x for _, _, x in own) <= 100 and size <= 256 and (size == 256 or size & (size - 1) == 0)
    assert sum(p.length for p in got) == sum(map(len, ids.values()))
    free = Counter()
    for p in packing.pack_conversations(frame, tokens=256, segments=6, loss=256).collect():
        free[p.sequence_id] += sum(loss[p.doc_id][p.start : p.start + p.length])
    assert max(free.values()) > 100  # the limit binds
    assert packing.pack_conversations(frame.limit(0)).count() == 0


def test_best_bin_has_the_greatest_dot_product():
    packer = packing.VectorPacker(100, 10, 50)
    packer.left, packer.ids, packer.bins = np.array([[90.0, 2, 10], [60, 9, 45], [20, 1, 50]]), np.arange(3), 3
    for demand in ([10, 1, 1], [10, 1, 10], [15, 1, 15], [70, 1, 5], [95, 1, 1]):
        d = np.array(demand, float)
        fits = [k for k in range(3) if (d <= packer.left[k]).all()]
        want = max(fits, key=lambda k: sum(a / c * b / c for a, b, c in zip(packer.left[k], d, (100, 10, 50), strict=True)), default=None)
        assert packer.best(d) == want


def test_packer_keeps_every_limit():
    rng = np.random.default_rng(3)
    for cut in (True, False):
        packer = packing.VectorPacker(64, 5, 40, open_bins=4, cut=cut)
        used = {}
        for _ in range(300):
            n = int(rng.integers(1, 90 if cut else 40))
            loss = rng.random(n) < 0.5
            placed = packer.place(n, loss)
            assert sum(x[3] for x in placed) == n and [x[2] for x in placed] == list(np.cumsum([0, *[x[3] for x in placed[:-1]]]))
            assert cut or len(placed) == 1
            for where, offset, start, length in placed:
                t, s, b = used.get(where, (0, 0, 0))
                assert offset == t
                used[where] = (t + length, s + 1, b + int(loss[start : start + length].sum()))
        assert all(t <= 64 and s <= 5 and b <= 40 for t, s, b in used.values())
        assert len(packer.closed) == len(set(packer.closed)) and set(packer.closed) | set(packer.ids) == set(used) and not set(packer.closed) & set(packer.ids)


def test_simhash_equals_brute_force(spark, odd, none):
    docs = odd.collect()

    def fingerprint(text):
        w = (text or "").encode().lower().split()
        grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    for hot in (64, 0):
        got = simhash.near_duplicates(odd, hot=hot).collect()
        assert len(got) == len(docs)
        want = Counter((r.doc_id, f"{fingerprint(r.text):016x}") for r in docs)
        assert Counter((r.doc_id, r.fingerprint) for r in got) == want
        fps = {(r.doc_id, int(r.fingerprint, 16)) for r in got}
        reach = {x: {y for y in fps if (x[1] ^ y[1]).bit_count() <= 2} for x in fps}
        while True:
            grown = {x: set().union(*(reach[y] for y in near)) for x, near in reach.items()}
            if grown == reach:
                break
            reach = grown
        assert all(r.component_id == min((y[0] for y in reach[r.doc_id, int(r.fingerprint, 16)] if y[0] is not None), default=None) for r in got)
    assert simhash.near_duplicates(none).count() == 0


def test_hamming_links_join_all_near_fingerprints(spark):
    rng = np.random.default_rng(5)
    fps = {int(x) for x in rng.integers(-(2**63), 2**63 - 1, 60)}
    centre = next(iter(fps))
    for _ in range(200):
        x = centre
        for b in rng.integers(0, 64, rng.integers(1, 4)):
            x ^= (1 << int(b)) if b < 63 else -(1 << 63)
        fps.add(x)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")

    def classes(edges):
        of = {x: x for x in fps}
        def root(x):
            while of[x] != x:
                x = of[x]
            return x
        for a, b in edges:
            of[root(a)] = root(b)
        return {frozenset(x for x in fps if root(x) == r) for r in {root(x) for x in fps}}

    mask = 2**64 - 1
    want = classes((a, b) for a in fps for b in fps if a < b and ((a ^ b) & mask).bit_count() <= 2)
    for hot in (1000, 3):
        assert classes((r.u, r.v) for r in simhash.hamming_links(df, hot).collect()) == want


def test_hamming_links_never_broadcast_probes(spark, tmp_path, monkeypatch):
    spark.range(3000).selectExpr("xxhash64(id) as fp").write.parquet(f"{tmp_path}/fps")
    plans = []
    monkeypatch.setattr(simhash, "written", lambda df, tag: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or df)
    simhash.hamming_links(spark.read.parquet(f"{tmp_path}/fps"))
    assert "SortMergeJoin" in plans[0] and ", Inner, Build" not in plans[0]


def kept_by_brute_force(texts, width=5):
    """Positions of one text of each component of 5-word Jaccard 0.8 or more (equal sets linked, no words one set); the first stays."""
    words = [(x or "").encode().lower().split() for x in texts]
    sets = [{tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set() for w in words]
    root = list(range(len(texts)))
    for j in range(len(texts)):
        for i in range(j):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return {i for i, r in enumerate(root) if i == r}


def test_dedup_keeps_one_of_each(spark, odd, none):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    want = {(rows[i].doc_id, rows[i].text) for i in kept_by_brute_force([r.text for r in rows])}
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(want) and set(got) == want
    assert simhash.one_of_each(none).count() == 0


def test_dedup_goes_by_row_not_by_id(spark):
    a, b = PROSE, "quite another text of more than five words that is no copy"
    for order in ([(5, a), (5, b), (1, b)], [(1, b), (5, b), (5, a)], [(5, b), (1, b), (5, a), (5, a), (1, b)]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        assert sorted(map(tuple, simhash.one_of_each(docs).collect())) == [(1, b), (5, a)]
    nulls = spark.createDataFrame([(None, a, "x", None), (None, a, None, "x"), (None, b, None, None)], "doc_id long, text string, lang string, source string")
    assert sorted(r.text for r in simhash.one_of_each(nulls).collect()) == sorted([a, b])


def test_dedup_finds_edited_copies(spark):
    rng = np.random.default_rng(7)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    texts = []
    for edits in (0, 1, 2, 4, 5, 6, 8, 12):
        for _ in range(12):
            base = word(150)
            other = list(base)
            for i in rng.choice(150, edits, replace=False):
                other[i] = "edit"
            texts += [" ".join(base), " ".join(other)]
    frame = word(120)
    for _ in range(80):  # a large group of copies, and texts that share a part only
        texts += [" ".join(frame + word(3)), " ".join(frame[:40] + word(40)), " ".join(frame[:9] + word(1))]
    for _ in range(60):  # copies of one text that are not all copies of each other
        own = list(frame)
        for i in rng.choice(120, 4, replace=False):
            own[i] = word(1)[0]
        texts.append(" ".join(own))
    kept = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert kept == kept_by_brute_force(texts) and len(texts) - len(kept) > 12 * 3 + 70


def test_dedup_links_by_simhash_first(spark, monkeypatch):
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base), " ".join([*base[:-1], "edit"]), " ".join(f"v{i}" for i in range(50))]
    seen, first = [], simhash.set_pairs
    monkeypatch.setattr(simhash, "set_pairs", lambda rows: (seen.append((first(rows).collect(), rows.collect())), first(rows))[1])
    assert simhash.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count() == 2
    (pairs, rows), = seen
    fps = {bytes(r.sid): r.fp for r in rows}
    near = lambda a, b: ((fps[a] ^ fps[b]) & (2**64 - 1)).bit_count() <= 2
    want = {frozenset((a, b)) for a in fps for b in fps if a < b and near(a, b)}
    assert {frozenset((bytes(p.u), bytes(p.v))) for p in pairs} == want and len(want) == 1


def test_rare_shingles_link_what_leaders_miss(spark):
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for k in range(30):  # all share a long passage; only neighbours in the chain are copies
        own = list(base)
        for j in range(k):
            own[2 * j] = f"e{j}"
        texts.append(" ".join(own))
    texts += [" ".join([f"v{x}" for x in rng.integers(0, 999, 40)]) for _ in range(10)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    docs = spark.createDataFrame([([i], x) for i, x in enumerate(texts)], "row array<long>, text string").coalesce(1)
    rows = near_copies.shingled(docs)
    one_key = rows.selectExpr("row", "sid", "n", "if(keys is null, null, array(7L)) as keys", "sign", "shingles")  # all share one
    of = {bytes(r.sid): r.row[0] for r in rows.collect()}
    stars = [(of[bytes(r.root)], of[bytes(r.node)]) for r in near_copies.copy_roots(one_key).collect()]
    like = {(i, j) for j in range(len(texts)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}

    def classes(pairs):
        root = list(range(len(texts)))
        for i, j in pairs:
            root = [root[i] if r == root[j] else r for r in root]
        return {frozenset(k for k, r in enumerate(root) if r == x) for x in root}

    assert classes(stars) == classes(like) and len(classes(like)) < len(texts) - 5


def test_components(spark):
    from terragrid.llm.components import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (150, 200)] + [(1000, 1000 + i) for i in range(1, 30)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert all(got[i] == 0 for i in range(41)) and got[200] == got[150] == 100 and got[1029] == 1000
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_quality_scores(spark, odd, none, labels):
    docs = spark.createDataFrame([(i, PROSE if i % 2 else "buy*** now!!! ###cheap $$$") for i in range(200)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    got = gbt_quality.quality_scores(docs, marks).collect()
    assert all(r.predicted == r.doc_id % 2 == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    got = gbt_quality.quality_scores(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert gbt_quality.quality_scores(none, labels).count() == 0
    assert gbt_quality.good_documents(odd, labels.limit(0)).columns == odd.columns


def test_forest_scores_as_its_trees_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(int)
    f = gbt_quality.fit(x, y)
    assert ((f.score(x) > 0.5) == y).mean() > 0.95
    total = f.base
    for t in range(len(f.leaf)):
        k = 0
        while k < f.feature.shape[1]:
            k = 2 * k + 1 + (x[0, f.feature[t, k]] > f.threshold[t, k])
        total += f.leaf[t, k - f.feature.shape[1]]
    assert abs(f.score(x[:1])[0] - 1 / (1 + math.exp(-total))) < 1e-12


def test_sharding_is_even_and_keeps_groups(spark, odd, none):
    texts = ["hot"] * 300 + [f"group {i // 4}" for i in range(200)] + [f"lone {i}" for i in range(283)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sharding.balanced_shards(docs, shards=8).collect()
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(got) == len(texts)
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    groups = {}
    for r in got:
        assert r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.law == "rows" and r.grown_shard is None
        groups.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert sum(len(v) > 1 for k, v in groups.items() if k.startswith("group")) <= 2 and len(groups["hot"]) <= 6
    got = sharding.balanced_shards(odd).collect()
    assert len(got) == odd.count() and max(Counter(r.shard for r in got).values()) == 1
    assert sharding.balanced_shards(none).count() == 0


@pytest.mark.parametrize("size", [2, 3, 5])
def test_sharding_places_all_groups_that_fit(spark, size):
    docs = spark.createDataFrame([(i, f"group {i // size}") for i in range(4000)], "doc_id long, text string")
    got = sharding.balanced_shards(docs).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.doc_id // size, set()).add(r.shard)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    room = 40 * (100 // size)  # groups that 40 shards of 100 rows can hold
    assert sum(len(v) > 1 for v in groups.values()) <= max(0, len(groups) - room)


def test_labels_propagate_as_by_hand(spark):
    """One round against plain loops: most frequent neighbour label, flows both ways and room, whole buckets."""
    rng = np.random.default_rng(8)
    rows = [(f"g{g}".encode(), 0, int(s)) for g in range(120) for s in rng.integers(0, 6, rng.integers(2, 5))]
    members = spark.createDataFrame([(*k, n) for k, n in Counter(rows).items()], "gid binary, chunk long, shard int, n long")

    def links(state):
        groups = {}
        for g, _, s, n in state:
            groups.setdefault(bytes(g), []).append(n)
        return sum((sum(v) ** 2 - sum(x * x for x in v)) // 2 for v in groups.values())

    capacity = -(-len(rows) // 6) + 4
    state, cuts = sharding.relabel(members, capacity, 6, fall=0.0001)
    state = state.collect()
    assert cuts[0] == links([(*k, n) for k, n in Counter(rows).items()]) and min(cuts) == links(state)
    assert all(a > b for a, b in zip(cuts[:-1], cuts[1:-1], strict=False)) and min(cuts) < cuts[0] / 4
    assert sum(r.n for r in state) == len(rows)
    load, before = Counter(), Counter(s for _, _, s in rows)
    for r in state:
        load[r.shard] += r.n
    assert all(n <= max(capacity, before[s]) for s, n in load.items())
    flows = sharding._flows({(0, 1): 5, (1, 0): 3, (2, 1): 4}, [0, 3, 9])
    assert flows == {(0, 1): 4, (1, 0): 3, (2, 1): 2}


def test_sharding_splits_rows_that_are_equal_in_all(spark):
    docs = spark.createDataFrame([(None, "same")] * 500 + [(7, "same")] * 300 + [(i, f"t{i}") for i in range(200)], "doc_id long, text string")
    got = sharding.balanced_shards(docs, shards=8).collect()
    counts = Counter(r.shard for r in got)
    assert set(counts.values()) == {125} and all(sorted(r.slot for r in got if r.shard == s) == list(range(125)) for s in counts)
    assert Counter((r.doc_id, r.size) for r in got)[None, 20] == 500


def brute_hits(text, items, width):
    own = decontamination.words(text)
    hit, names = set(), set()
    for name, item in items:
        for w in decontamination.windows(decontamination.words(item), width):
            for i in range(len(own) - len(w) + 1):
                if tuple(own[i : i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    names.add(str(name))
    return len(own), len(hit), sorted(names)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontamination_equals_brute_force(spark, odd, none, block_bytes):
    import hashlib

    items = [(1, PROSE), (2, "a B"), (3, None), (4, ""), (10, "over the lazy dog and then runs far away from all of the noisy"), (11, "dog dog dog dog dog dog dog dog dog dog dog dog dog")]
    bench = spark.createDataFrame([(*x, "t") for x in items], "item_id long, text string, lang string")
    docs = odd.unionByName(spark.createDataFrame(rows_of("dog " * 30, "a b a b a", PROSE[4:] + " " + PROSE), SCHEMA).withColumn("doc_id", odd.sparkSession.range(1).select("id").first()[0] + __import__("pyspark.sql.functions", fromlist=["x"]).col("doc_id") + 100))
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    got = decontamination.decontaminate(docs, bench, 5, block_bytes=block_bytes).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None:
            n, hit, names = brute_hits(text[r.doc_id], items, 5)
            assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(names)), r
            assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest() and r.contaminated == (hit > 0 and 20 * hit >= n)
    clean = decontamination.clean_documents(docs, bench, 5, block_bytes=block_bytes)
    want = Counter((r.doc_id, r.text) for r in docs.collect() if not (lambda n, hit, _: hit and 20 * hit >= n)(*brute_hits(r.text, [x for x in items if x[0] is not None], 5)))
    assert clean.columns == docs.columns and Counter((r.doc_id, r.text) for r in clean.collect()) == want
    assert decontamination.decontaminate(none, bench, 5, block_bytes=block_bytes).count() == 0
    assert not any(r.contaminated for r in decontamination.decontaminate(docs, bench.limit(0), 5).collect())
    assert decontamination.clean_documents(none, bench, 5, block_bytes=block_bytes).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_rows_go_by_text_whatever_their_ids(spark, block_bytes):
    rows = [(None, PROSE), (7, PROSE), (7, "clean words only here"), (None, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame([(1, PROSE), (2, "some other words"), (None, "clean words only here")], "item_id long, text string")
    got = decontamination.clean_documents(docs, bench, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got), key=str) == sorted(rows[2:], key=str)


def test_long_items_and_texts_are_cut_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(3)
    long = [f"w{x}" for x in rng.integers(0, 40, 300)]
    docs = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(long[100:130]))], "doc_id long, text string")
    bench = spark.createDataFrame([("a", " ".join(long[50:250])), ("b", "w1")], "item_id string, text string")
    want = sorted(decontamination.decontaminate(docs, bench, 5).collect())
    monkeypatch.setattr(decontamination, "PART_WORDS", 9)  # read on the driver only
    assert sorted(decontamination.decontaminate(docs, bench, 5, block_bytes=100).collect()) == want
    raw = " ".join(long).encode()
    for size in (1, 7, 100, 10**6):
        assert [w for run in common.runs(raw, size) for w in run.split()] == raw.split()
    assert list(common.runs(b"")) == []


def test_proximity():
    seg = decontamination.Segment(*decontamination.postings(["a x b x x c a"]))
    assert seg.near([b"a", b"b"], 2) == [2] and seg.near([b"a", b"b"], 1) == []
    assert seg.near([b"a", b"b", b"c"], 1) == [] and seg.near([b"c", b"a"], 1) == [5] and seg.near([b"a", b"a"], 0) == [0, 6]
    assert seg.near([], 3) == [] and seg.near([b"a", b"zz"], 9) == []


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_matches_equal_brute_force(spark, none, block_bytes):
    docs = {1: "x a b c x c b a", 2: "c x x x b", 3: None, 4: "A-B, c! a b c", 5: ""}
    items = {"p": "a b c", "q": "b c", "r": "zz a", "s": None, "t": "a b c"}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(items.items()), "item_id string, text string")
    got = decontamination.matches(frame, bench, 3, distance=2, block_bytes=block_bytes).collect()
    want = set()
    for d, text in docs.items():
        own = decontamination.words(text)
        for k, item in items.items():
            for w in decontamination.windows(decontamination.words(item), 3):
                want |= {(d, k, i, len(w)) for i in range(len(own) - len(w) + 1) if tuple(own[i : i + len(w)]) == w}
    assert {(r.doc_id, r.item_id, r.at, r.length) for r in got if r.exact} == want and len(want) == 9
    near = {(r.doc_id, r.item_id) for r in got if not r.exact}
    assert near == {(d, k) for d in (1, 4) for k in "pqt"} and all(r.length == 1 for r in got if not r.exact)
    assert {(r.doc_id, r.item_id) for r in decontamination.matches(frame, bench, 3, distance=4).collect()} >= {(2, "q")}
    assert decontamination.matches(none, bench, 3, block_bytes=block_bytes).count() == 0
    with pytest.raises(ValueError):
        decontamination.matches(frame, bench, 3, distance=decontamination.GAP)


def test_urls():
    f = url_filter.host_and_path
    assert f("HTTPS://WWW.Ex.Org/A/b?x#y") == ("www.ex.org", "/A/b") and f("http://a.net#t") == ("a.net", "") and f(None) == f("a/b") == ("", "")
    r = url_filter.rule_of
    assert r("x.example.net", "/en/1") == ("example.net/en/", "allow") and r("net", "/") == ("net/", "block") and r("a.net", "") == (None, None)
    assert r("m.example.com", "/de/") == ("example.com/de/", "block") and r("notexample.com", "/de/") == (None, None) and r("b.org", "/fr/x") == ("org/fr/", "allow")


def test_registered_names_are_scored(spark):
    words = url_filter.WordModel({w: 50 for w in (*url_filter.SPAM, *url_filter.PLAIN)})
    split = lambda host: [x[2:] for x in url_filter.tokens(host, "", words)]
    assert split("www.freebets.com") == ["www", "free", "bets"] and split("freebets.com") == ["free", "bets"]
    assert split("m.cheappills.co.uk") == ["m", "cheap", "pills"] and split("localhost")
    hosts = ["www.freebets.com", "m.onlinecasino.info", "blog.cheappills.co.uk", "www.healthnews.com", "m.musicworld.info", "blog.schoolbook.co.uk"]
    pages = spark.createDataFrame([(i, f"http://{h}/x/{i}") for i, h in enumerate(hosts * 5)], "page_id long, url string")
    got = {(r.host, r.verdict) for r in url_filter.url_verdicts(pages).collect()}
    assert got == {(h, "block" if i < 3 else "allow") for i, h in enumerate(hosts)}


def test_viterbi_finds_the_best_split():
    import itertools

    model = url_filter.WordModel({"free": 9, "bets": 5, "freeb": 1, "be": 2, "ts": 2})

    def cost(parts):
        return sum(model.cost.get(p, model.unknown + 2.5 * len(p)) for p in parts)

    word = "freebets"
    every = [[word[a:b] for a, b in itertools.pairwise((0, *cuts, len(word)))] for n in range(len(word)) for cuts in itertools.combinations(range(1, len(word)), n)]
    assert list(model.split(word)) == ["free", "bets"] and abs(cost(model.split(word)) - min(map(cost, every))) < 1e-9


def test_margins_equal_naive_bayes_by_hand(spark):
    hosts = ["www.cheappills.com", "blog.goldwatch.com", "m.schoolnews.info", "www.gardentips.info", "x.example.net"]
    paths = ["/gold/watch/pills", "/garden/tips/", "/school/news", "/casino/watch", ""]
    urls = [f"http://{h}{p}?q" for h in hosts for p in paths] * 2 + [None, "nothing", "http://www.goldwatch.com/gold/watch"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    words = url_filter.word_model(pages)
    assert words.split("goldwatch") == ("gold", "watch") and words.split("gardentips") == ("garden", "tips")
    parts = [url_filter.host_and_path(u) for u in urls]
    features = [url_filter.tokens(h, p, words) for h, p in parts]
    label = [url_filter.distant_label(h, p, x) for (h, p), x in zip(parts, features, strict=True)]
    n = [Counter(url_filter.buckets([w for x, y in zip(features, label, strict=True) if y == c for w in x])) for c in (0, 1)]

    def margin(x):
        p = [[(n[c][b] + 1) / (sum(n[c].values()) + url_filter.FEATURES) for b in url_filter.buckets(x)] for c in (0, 1)]
        return math.log((sum(label) + 1) / (len(label) - sum(label) + 1)) + sum(math.log(b / a) for a, b in zip(*p, strict=True))

    got = {r.page_id: r for r in url_filter.url_verdicts(pages).collect()}
    assert all(abs(got[i].margin - margin(x)) < 1e-4 for i, x in enumerate(features))
    assert all(got[i].verdict == (url_filter.rule_of(*p)[1] or ("block" if got[i].margin > 0 else "allow")) for i, p in enumerate(parts))
    beyond = [i for i, x in enumerate(features) if not any(w[2:] in url_filter.SPAM for w in x) and url_filter.rule_of(*parts[i])[1] is None and got[i].verdict == "block"]
    assert beyond  # a verdict that no listed word implies


def test_url_verdicts(spark):
    hosts = ["goodnews", "cheappills", "quietblog", "freebets"]
    rows = [(i, f"https://www.{hosts[i % 4]}.example.com/en/{i}", "h", "x") for i in range(200)] + [(None, None, None, None), (5, "https://www.cheappills.example.com/en/5", "h", "x"), (900, "x" * 200_000, "h", "x"), (901, "http://" + "x" * 100_000 + ".info/" + "ab " * 9000, "h", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = url_filter.url_verdicts(pages).collect()
    assert len(got) == len(rows)
    assert all(r.verdict == ("block" if r.page_id % 2 else "allow") for r in got if r.page_id is not None and r.page_id < 200)
    assert url_filter.url_verdicts(pages.limit(0)).count() == 0


def test_quality_rules_counts():
    m = quality_rules.measure
    assert m(None) == (0, 0, 0, 0, 0, True, False, 0) == m(" \n")
    assert m("a b\na b\n\nc#")[:4] == (5, 6, 1, 1)
    w = [b"a", b"b", b"c", b"d", b"e"]
    assert quality_rules.repeated_words(w * 2) == 10 and quality_rules.repeated_words(w + [b"x"] + w) == 10 and quality_rules.repeated_words(w) == 0
    assert m(PROSE)[5:7] == (False, True)
    junk = "one*** two%%% three$$$ four&&& five### six*** seven*** eight*** nine*** ten*** more***"
    assert m(junk)[5:7] == (False, False) and m(PROSE + "\nhome | news | about")[5:7] == (False, True)
    assert quality_rules.clean(PROSE + "\nhome | news | about") == PROSE
    assert quality_rules.clean(PROSE + "\n\n" + PROSE) == PROSE + "\n\n" + PROSE and quality_rules.clean(None) == ""


def test_quality_rules_frames(odd, none):
    got = quality_rules.quality_rules(odd).collect()
    assert len(got) == odd.count() and quality_rules.quality_rules(none).count() == 0
    kept = quality_rules.kept_documents(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [3, 3, 4, 8]


def test_failed_lines_leave_kept_documents(spark):
    rows = [(1, PROSE + "\n\nAll rights reserved.", None, "s", 5), (2, PROSE + "\n\n" + PROSE.upper(), "en", None, 7), (3, "home | news | about", "en", "s", None)]
    got = quality_rules.kept_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert sorted(map(tuple, got)) == [(1, PROSE + "\n", None, "s", len(PROSE) + 1), rows[1]]
    bare = quality_rules.kept_documents(spark.createDataFrame([(rows[0][1],)], "text string")).collect()
    assert [tuple(r) for r in bare] == [(PROSE + "\n",)]


@pytest.mark.parametrize(("table_words", "most_bits"), [(1 << 20, 1 << 30), (4, 0)])
def test_scores_equal_brute_force(spark, odd, none, table_words, most_bits):
    """Base scores from exact counts; scores by a filter made here."""
    docs = odd.collect()
    c, pairs = Counter(), Counter()
    words = lambda text: [*(text or "").encode().lower().split(), None]
    for r in docs:
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10:
            own = words(r.text)
            c.update(own)
            pairs.update(zip([0, *own], own, strict=False))
    n, v = sum(c.values()), len(c)
    once, twice = (sum(x == k for x in pairs.values()) for k in (1, 2))
    d = once / (once + 2 * twice)
    mass = d * len(pairs) / n
    one_hash = lambda w: bloom_lm.END if w is None else bloom_lm.BEGIN if w == 0 else np.uint64(xxhash.xxh64_intdigest(w, seed=bloom_lm.SEED))
    key = lambda u, w: bloom_lm.mixed(np.array([one_hash(u)]) * bloom_lm._M1 + one_hash(w))[0]
    stored = {one_hash(w): x for w, x in c.items()} | {key(u, w): x for (u, w), x in pairs.items()}
    h, q = np.array(list(stored), np.uint64), bloom_lm.level(np.array(list(stored.values())))
    of = bloom_lm.of_block(h, 256)
    bloom = bloom_lm.LogBloom.joined({k: bloom_lm.LogBloom.block_bits([(h[of == k], q[of == k])]) for k in range(256) if (of == k).any()}, 256)
    count = lambda x: bloom_lm.LEVEL_COUNT[bloom.levels(np.array([x]))[0]]
    smoothed = lambda x: (x + 0.1) / (n + 0.1 * (v + 1))

    def score(own):
        total = 0
        for u, w in zip([0, *own], own, strict=False):
            context, one = count(one_hash(None if u == 0 else u)), count(one_hash(w))
            both = min(count(key(u, w)), context, one)
            total += math.log10(min(1, max(both - d, 0) / context + mass * smoothed(one)) if context else smoothed(one))
        return total

    got = bloom_lm.lm_scores(odd, table_words=table_words, most_bits=most_bits).collect()
    assert len(got) == len(docs)
    for r in got:
        text = next(x.text for x in docs if x.doc_id == r.doc_id and (x.doc_id is not None or len((x.text or "").split()) + 1 == r.n_tokens))
        own = words(text)
        assert abs(r.base_score - sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)) < 1e-6
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(c[w] > 0 for w in own), n)
        assert abs(r.score - score(own)) < 1e-9
    assert bloom_lm.lm_scores(none, table_words=table_words, most_bits=most_bits).count() == 0


def test_what_is_broadcast_changes_no_score(spark):
    rng = np.random.default_rng(6)
    docs = spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 50) % 3000)) for i in range(300)], "doc_id long, text string").repartition(5)
    a, b = ({r.doc_id: r for r in bloom_lm.lm_scores(docs, most_bits=bits, table_words=words).collect()} for bits, words in ((1 << 30, 1 << 20), (0, 50)))
    assert all(abs(a[i].score - b[i].score) < 1e-9 and abs(a[i].base_score - b[i].base_score) < 1e-9 and a[i].n_known == b[i].n_known for i in a) and len(a) == len(b) == 300


def test_gathered_filter_equals_its_parts(spark):
    parts = {0: bytes(range(24)), 3: b"\xff" * 9, 6: bytes(8)}
    got = bloom_lm.LogBloom.gathered(spark.createDataFrame([(k, bytearray(x)) for k, x in parts.items()], "block int, bits binary"), 8)
    want = bloom_lm.LogBloom.joined(parts, 8)
    assert all((getattr(got, x) == getattr(want, x)).all() for x in ("bits", "starts", "sizes")) and got.shift == want.shift


def test_ngrams_sent_to_a_large_filter_are_deleted_share_by_share(spark):
    docs = spark.createDataFrame([(i, f"a b w{i}") for i in range(60)], "doc_id long, text string").repartition(3)
    left = lambda: {p.name for tag in ("asked", "levels") for p in Path(common.shared_dir(spark)).glob(f"{tag}-*")}
    before = left()
    got = bloom_lm.lm_scores(docs, most_bits=0)
    assert got.count() == 60 and left() == before


def test_bloom_levels_are_never_too_low():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    q = rng.integers(1, 9, 5000)
    of = bloom_lm.of_block(h, 4)
    f = bloom_lm.LogBloom.joined({b: bloom_lm.LogBloom.block_bits([(h[of == b], q[of == b])]) for b in range(4)}, 4)
    got = f.levels(h)
    assert (got >= q).all() and (got == q).mean() > 0.97
    assert (f.levels(rng.integers(0, 2**64, 5000, dtype=np.uint64)) == 0).mean() > 0.97
    assert list(bloom_lm.level(np.array([1, 2, 3, 4, 1000]))) == [1, 2, 2, 3, 10]
