"""The operators against brute force, the public libraries and awkward rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tokenloom.llm import bytebpe, minhash, packing, pivots, queries, sharding, simhash, suffixes, tokens, toxicity, urls

DOCS = "doc_id bigint, text string, component_id string, shard string"
BASE = "the quick brown fox jumps over the lazy dog while seven wizards quietly brew a potion in the old tower near the river"
AWKWARD = [
    (1, BASE, "x", None), (2, BASE + " today", "x", None), (3, BASE, None, "y"), (4, None, None, None), (5, "", None, None),
    (6, "   ", None, None), (7, "two words", None, None), (8, "two words", None, None), (8, "two words", None, None),
    (9, "ß çà 漢字 😀 " * 40, None, None), (10, "a" * 9000, None, None), (11, (BASE + " and then more. ") * 40, None, None),
    (None, BASE, None, None), (12, "pre " + BASE + " post", None, None),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_minhash_equals_brute_force(spark, awkward, none):
    got = {(r.doc_id, r.n_shingles): r for r in minhash.near_duplicates(awkward, width=3, percent=85).collect()}
    sets = {}
    for doc, text, *_ in AWKWARD:
        words = (text or "").encode().lower().split()
        sets[doc] = {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()
    low = {d: d for d in sets if d is not None}
    for _ in sets:
        for a, b in itertools.combinations(low, 2):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                low[a] = low[b] = min(low[a], low[b])
    for (doc, n), r in got.items():
        assert n == len(sets[doc])
        if doc is not None:
            assert r.component_id == low[doc] and r.kept == (doc == low[doc])
    assert minhash.near_duplicates(none).count() == 0
    kept = minhash.keep_one(awkward, width=3, percent=85)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(d for d in low if low[d] == d)


def test_large_bucket_loses_no_link(spark):
    """A chain in which neighbours are similar and the ends are not."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i:4 * i + 160]), None, None) for i in range(50)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, DOCS), width=3, percent=85).collect()
    assert {r.component_id for r in got} == {0}


def test_odd_sketch_counts_differences():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 32, minhash.SAMPLES, dtype=np.uint32)
    b = a.copy()
    b[:20] += np.uint32(1)
    bits = sum(int(x).bit_count() for x in (minhash.odd_sketch(a) ^ minhash.odd_sketch(b)).view(np.uint64))
    assert 28 <= bits <= 40 and bits <= minhash.sketch_limit(85)


def brute_repeats(rows, span=50):
    starts = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - span + 1):
            if doc is not None:
                key = data[i:i + span]
                starts[key] = min(doc, starts.get(key, doc))
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - span + 1):
            if doc is not None and starts[data[i:i + span]] < doc:
                gone[i:i + span] = b"\1" * span
        yield doc, bytes(c for c, g in zip(data, gone, strict=True) if not g)


@pytest.mark.parametrize("hot", [100_000, 2])
def test_suffixes_equal_brute_force(spark, awkward, none, hot):
    got = suffixes.remove_repeats(awkward, hot=hot).collect()
    want = list(brute_repeats([(d, t) for d, t, *_ in AWKWARD]))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, bytes(r.kept)) for r in got), key=key) == sorted(want, key=key)
    assert suffixes.remove_repeats(none).count() == 0
    assert suffixes.without_repeats(awkward).columns == awkward.columns


def test_runs_merge_in_order():
    rng = np.random.default_rng(3)
    records = sorted({bytes(rng.integers(97, 99, 12, dtype=np.uint8)) for _ in range(400)})
    runs = [suffixes.front_code([(s, b"", [(0, i)]) for i, s in enumerate(records) if i % 3 == k], [(k, k)]) for k in range(3)]
    merged = list(suffixes.merge_runs(runs))
    assert [s for s, *_ in merged] == records
    for (a, *_), (b, _, _, shared) in zip(merged, merged[1:], strict=False):
        assert shared == suffixes._common(a, b)


def test_packing_equals_the_library(spark, awkward, none, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    encode = packing.WordEncoder(path)
    for text in [*texts, "ΣΑΣ <|endoftext|>x", "é ́x", "日本 語　x", "\x1c a\x85b"]:
        assert encode(text) == encode.tokenizer.encode(text, add_special_tokens=False).ids
    rows = packing.pack_documents(awkward, path, length=64, with_ids=True).collect()
    assert packing.pack_documents(none, path).count() == 0
    places = {}
    for r in rows:
        assert 0 < r.length <= 64 and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and sum(n for _, n in own) <= 64
    assert len(places) <= -(-sum(r.length for r in rows) // 64) + 1


def test_latin_words_are_cut_before_the_model(texts, monkeypatch):
    """The whole pipeline of the library sees only words with other letters; the parts of the rest go to its model."""
    encode = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    expected = [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    asked = []
    plain = packing.WordEncoder._library
    monkeypatch.setattr(packing.WordEncoder, "_library", lambda self, parts: asked.extend(parts) or plain(self, parts))
    assert [encode(t) for t in texts] == expected
    latin = "Größe, NAÏVE's ÿx×÷ ª²¼ x1\x7f\x01 \x0b_"
    assert encode(latin) == encode.tokenizer.encode(latin, add_special_tokens=False).ids
    assert not [w for w in asked if packing._LATIN.fullmatch(w) and "<|" not in w]
    encode.cuts, encode.words = False, {}
    assert encode(latin) == encode.tokenizer.encode(latin, add_special_tokens=False).ids


def test_word_encoder_outlives_its_memo(texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    small, large = packing.WordEncoder(path, limit=5), packing.WordEncoder(path)
    for text in ["a b c", "a b d e f g", "c", *texts]:
        assert small(text) == large(text)


def test_token_counts_equal_the_library(texts):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = tokens.zipf_vocabulary(queries.PIECE_MODEL)
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement=tokens.MARK, prepend_scheme="always", split=True)
    count = tokens.UnigramCounter(vocabulary, True)
    for text in [*texts, None, "x" * 3000, "▁ ▁▁", "<0x0A><unk>"]:
        assert count(text) == len(library.encode(text or "", add_special_tokens=False).ids)


def test_sharding(spark, awkward, none):
    rows = sharding.shard_by_bytes(awkward, 3).collect()
    assert len(rows) == len(AWKWARD) and sharding.shard_by_bytes(none, 3).count() == 0
    for shard in range(3):
        own = [r for r in rows if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert sharding.pack_groups({"a": 6, "b": 5, "c": 4, "d": 3, "e": 2}, 10) == {"a": 0, "b": 1, "c": 0, "d": 1, "e": 1}
    sizes = {i: 10 + i % 7 for i in range(500)}
    shards = sharding.even_shards(sizes, 8)
    totals = [sum(sizes[k] for k in sizes if shards[k] == s) for s in range(8)]
    assert max(totals) - min(totals) <= 20


def test_byte_bpe_equals_tiktoken(spark, awkward, none, texts):
    import tiktoken

    both = bytebpe.ByteCodec(queries.BYTE_RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=both.ranks, special_tokens={})
    for text in [*texts, "\n\n  a", "x" * 3000, "▁ <|endoftext|>", "\x00\x85 "]:
        ids = both.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert both.decode(ids) == text.encode()
    rows = bytebpe.encode_documents(awkward, queries.BYTE_RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in rows) == sorted((t or "").encode() for _, t, *_ in AWKWARD)
    assert bytebpe.encode_documents(none, queries.BYTE_RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_outlives_its_memo(monkeypatch, texts):
    monkeypatch.setattr(bytebpe, "MEMO", 5)
    small = bytebpe.ByteCodec(queries.BYTE_RANKS, public_tokenizers.PATTERN)
    for text in ["a b c", "a b d e", "c", *texts]:
        assert small.decode(small.encode(text)) == text.encode()
    monkeypatch.undo()
    large = bytebpe.ByteCodec(queries.BYTE_RANKS, public_tokenizers.PATTERN)
    assert [small.encode(t) for t in texts] == [large.encode(t) for t in texts]


def test_urls(spark):
    rows = [(1, "https://A.example.org/es/1?x"), (2, "http://example.org/en/12"), (3, "http://example.org/en/2"), (4, None),
            (5, "no scheme"), (6, "ftp://Ä.X.com/de/"), (7, "http://com/fr/a#/b"), (8, "http://notexample.net"), (8, "http://notexample.net"),
            (9, "http://h.net/" + "s/" * 50)]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in rows], "page_id bigint, url string, host string")
    got = {r.page_id: r for r in urls.judge_pages(pages, queries.URL_RULES).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in (1, 2, 3, 4, 6, 7, 8)] == [
        ("a.example.org", "/es/1", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"),
        ("example.org", "/en/2", "org/"), ("", "", None), ("Ä.x.com", "/de/", "com/de/"), ("com", "/fr/a", "com/fr/"), ("notexample.net", "", None)]
    assert [got[i].verdict for i in (1, 2, 3, 6, 7)] == ["block", "block", "allow", "block", "allow"]
    assert urls.judge_pages(pages.limit(0), queries.URL_RULES).count() == 0


def test_rows_near_a_fingerprint(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = [(i, b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5)))) for i, b in enumerate(base * 40)] + [(None, base[0]), (1000, 0), (1001, 0)]
    df = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in prints], "id bigint, fingerprint bigint")
    got = simhash.rows_near(df, F.col("id") % 10 == 0).collect()
    want = {i: sum((p ^ q).bit_count() <= 3 for _, q in prints) - 1 for i, p in prints if i is not None and i % 10 == 0}
    assert len(got) == len(prints) and {r.id: r.near_rows for r in got if r.near_rows is not None} == want
    assert simhash.rows_near(df.limit(0), F.col("id") % 10 == 0).count() == 0


def plain_templates(paths):
    """``{(host, path): template}`` from ``{(host, path): (labelled, blocked)}``, one node after the other."""
    def likelihood(n, hits):
        return sum(p * math.log(p / n) for p in (hits, n - hits) if p)

    found = {}

    def grow(rows, prefix, level):
        branches = defaultdict(lambda: [0, 0])
        for key, segments in rows:
            for k in (0, 1):
                branches[segments[level]][k] += paths[key][k]
        bins = {s: b * urls.BINS // n for s, (n, b) in branches.items() if n}
        total, best = [sum(branches[s][k] for s in bins) for k in (0, 1)], (0.0, 0)
        for cut in sorted(set(bins.values())):
            low = [sum(branches[s][k] for s in bins if bins[s] <= cut) for k in (0, 1)]
            high = [t - x for t, x in zip(total, low, strict=True)]
            if high[0]:
                best = max(best, (round(2 * (likelihood(*low) + likelihood(*high) - likelihood(*total)), 9), -cut))
        side = {s: int(best[0] >= urls.CUT and bins[s] > -best[1]) for s in bins}
        for key, segments in rows:
            if segments[level] not in side:
                found[key] = "".join("/" + s for s in segments)
        for k in (0, 1):
            names = [s for s in side if side[s] == k]
            inside = [(key, segments) for key, segments in rows if segments[level] in names]
            node = f"{prefix}/{names[0] if len(names) == 1 else f'?{k}'}"
            n, b = (sum(branches[s][j] for s in names) for j in (0, 1))
            deeper = []
            for key, segments in inside:
                if len(segments) == level + 1:
                    found[key] = node
                elif b in (0, n):
                    found[key] = node + "/**"
                else:
                    deeper.append((key, segments))
            if deeper:
                grow(deeper, node, level + 1)

    by_host = defaultdict(list)
    for key in paths:
        segments = ["*" if re.search("[0-9]", s) else s for s in key[1].split("/")[1:]]
        if segments:
            by_host[key[0]].append((key, segments))
        else:
            found[key] = ""
    for rows in by_host.values():
        grow(rows, "", 0)
    return found


def test_templates_against_a_plain_tree(spark):
    rng = random.Random(6)
    paths = {("h1", ""): (3, 1), ("h1", "/"): (2, 0), ("h2", "/" * 9 + "de"): (9, 9), ("h2", "/" * 9 + "fr"): (9, 0), ("h3", "/" + "x" * 50_000): (0, 0)}
    for _ in range(1500):
        segments = [rng.choice(["a", "b", "c", "p1", "p2", ""]) for _ in range(rng.randint(1, 5))]
        n = rng.choice([0, 0, 1, 4])
        share = 0.9 if segments[0] == "a" and segments[-1] == "b" else 0.5 if len(segments) > 3 else 0.1
        paths[rng.choice(["h1", "h2", "h4"]), "/" + "/".join(segments)] = n, sum(rng.random() < share for _ in range(n))
    df = spark.createDataFrame([(h, p, 1, *v) for (h, p), v in paths.items()], "host string, path string, n bigint, labelled bigint, blocked bigint")
    got = {(r.host, r.path): r.template for r in urls.templates(df).collect()}
    assert got == plain_templates(paths)
    assert got["h2", "/" * 9 + "de"] != got["h2", "/" * 9 + "fr"] and any("?" in t for t in got.values())


def test_an_unlabelled_branch_is_not_blocked_for_its_siblings(spark):
    """Labels say to block one branch of a host; its other branches follow their own paths elsewhere."""
    rows = [f"http://a.com/de/x{i}" for i in range(30)] + [f"http://a.com/es/y{i}" for i in range(9)] + [f"http://b.com/fr/z{i}" for i in range(40)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")
    got = {r.page_id: r.verdict for r in urls.judge_pages(pages, [("block", "com", "/de/"), ("allow", "com", "/fr/")]).collect()}
    assert {got[i] for i in range(30)} == {"block"} and {got[i] for i in range(30, 79)} == {"allow"}


def test_groups_that_fit_a_shard_stay_together(spark):
    rows = [(100 * g + i, f"{g:02d}" * 500) for g in range(12) for i in range(8)] + [(5000 + i, str(i)) for i in range(400)] + [(9000 + i, "big" * 300) for i in range(80)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id bigint, text string"), 8).collect()
    shards = defaultdict(set)
    for r in got:
        shards[r.text_crc32].add(r.shard)
    spread = [len(s) for s in shards.values()]
    assert max(spread) > 1 and sum(n > 1 for n in spread) == 1 and len(got) == len(rows)


def test_pivots_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    x = np.repeat(centres, 8, axis=0) + 0.15 * rng.normal(size=(320, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, x[0].tolist()), (901, None), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] * 16)]
    got = {r.vec_id: r for r in pivots.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()}
    y = np.vstack([x, x[0]]).astype(np.float32).astype(np.float64)
    y /= np.linalg.norm(y, axis=1)[:, None]
    want = (y @ y.T >= 0.9).sum(axis=1) - 1
    found = np.array([got[i].n_links for i in [*range(320), 900]])
    assert (found <= want).all() and found.sum() >= 0.9 * want.sum()
    assert all(got[i].n_links == 0 and got[i].kept for i in (901, 902, 903, 904))
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert pivots.near_vectors(empty).count() == 0


def linked_rows(spark, x, **options):
    """``(found, want)``: links of each row, from the operator and by brute force."""
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in pivots.near_vectors(frame, **options).collect()}
    y = x / np.linalg.norm(x, axis=1)[:, None]
    return np.array([got[i] for i in range(len(x))]), (y @ y.T >= 0.9).sum(axis=1) - 1


def around(rng, centres, cosine):
    """A random vector at about this cosine from each centre."""
    noise = rng.normal(size=centres.shape)
    unit = centres / np.linalg.norm(centres, axis=1)[:, None]
    noise -= (noise * unit).sum(axis=1)[:, None] * unit
    return cosine * unit + np.sqrt(1 - cosine ** 2) * noise / np.linalg.norm(noise, axis=1)[:, None]


@pytest.mark.parametrize("cosine", [0.95, 0.88])
def test_pivots_hold_a_dense_group(spark, cosine):
    """A third of the rows in one group, at this cosine from each other."""
    rng = np.random.default_rng(2)
    group = around(rng, np.repeat(rng.normal(size=(1, 64)), 1000, axis=0), np.sqrt(cosine))
    found, want = linked_rows(spark, np.vstack([group, rng.normal(size=(2000, 64))]))
    assert (found <= want).all() and found.sum() >= 0.95 * want.sum() > 0


def test_pivots_hold_at_full_number():
    """Unrelated pairs just above the threshold, by the keys that they share among 1,024 pivots."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    one = rng.normal(size=(1500, 64))
    rows = np.vstack([one, around(rng, one, 0.905)])
    batch = pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in rows], pa.binary())], names=["vector"])
    described, = pivots._described({64: rng.normal(size=(pivots.MAX_PIVOTS, 64))}, pivots.NEAR)([batch])
    keys = [set(k) for k in described.column("keys").to_pylist()]
    assert np.mean([bool(a & b) for a, b in zip(keys[:1500], keys[1500:], strict=True)]) >= 0.95


def test_vectors_of_every_length_are_compared(spark):
    rng = np.random.default_rng(5)
    lengths = {64: 600, 32: 300, 8: 6, 3: 1}
    parts = [np.vstack([x, around(rng, x, 0.95)]) for x in (rng.normal(size=(n, k)) for k, n in lengths.items())]
    rows = [(i, v.tolist()) for i, v in enumerate(v for p in parts for v in p)]
    got = {r.vec_id: r.n_links for r in pivots.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    at = 0
    for p in parts:
        y = p / np.linalg.norm(p, axis=1)[:, None]
        want = (y @ y.T >= 0.9).sum(axis=1) - 1
        found = np.array([got[at + i] for i in range(len(p))])
        at += len(p)
        assert (found <= want).all() and found.sum() >= 0.95 * want.sum() > 0


def test_few_pivots_make_one_list(spark):
    rng = np.random.default_rng(3)
    found, want = linked_rows(spark, around(rng, np.ones((700, 64)), np.sqrt(0.9)))
    assert (found == want).all() and want.sum() > 0


def test_simhash(spark, awkward, none):
    rows = simhash.edited_fingerprints(awkward.where("doc_id is not null").dropDuplicates(["doc_id"])).orderBy("doc_id").collect()
    ids = sorted({(d, t or "") for d, t, *_ in AWKWARD if d is not None})
    for (doc, text), (_, following), r in zip(ids, [*ids[1:], ids[0]], rows, strict=True):
        k = len(text) // 4
        assert r.doc_id == doc and r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256((text[:len(text) - k] + following[:k]).encode()).hexdigest()
    assert rows[0].fingerprint == rows[2].fingerprint
    assert simhash.edited_fingerprints(none).count() == 0
    prints = spark.createDataFrame([(0, 5), (1, 4), (2, 5 ^ (7 << 40)), (3, -6), (4, 5 ^ (15 << 20))], "id bigint, fingerprint bigint")
    found = {(r.query_id, r.id, r.distance) for r in simhash.neighbours(prints, prints).collect()}
    assert found == {(0, 1, 1), (1, 0, 1), (0, 2, 3), (2, 0, 3)}


def test_simhash_keeps_repeated_rows(spark):
    rows = AWKWARD + 3 * [(8, "two words", None, None), (None, BASE, None, None), (4, None, None, None)]
    got = simhash.edited_fingerprints(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == sorted((d or 0, len(t or "")) for d, t, *_ in rows)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model).where(toxicity.held_out("doc_id")).join(labels, "doc_id").select("_score", "toxic").toPandas()
    rank, toxic = scored["_score"].rank(), scored["toxic"] == 1
    auc = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.85
    assert toxicity.locate(docs, model).join(labels.where("toxic = 1"), "doc_id").count() > 0


def test_toxicity_rules(spark, awkward, none):
    model = toxicity.Model({b"vile": 9.0}, -5.0)
    rows = spark.createDataFrame([(1, "Fine. So VILE! Good."), (2, None), (3, ""), (4, "fine")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in toxicity.score(rows, model).collect()}
    assert got[1]["_score"] > 0.9 and got[1]["_sentence"] == 1 and got[2]["_score"] == got[3]["_score"] == 0.0
    assert [(r.doc_id, r.sentence) for r in toxicity.locate(rows, model).collect()] == [(1, 1)]
    assert toxicity.score(awkward, model).count() == len(AWKWARD) and toxicity.score(none, model).count() == 0
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.train(awkward, empty).weights == {}


def test_pipeline_stages_keep_clean_documents(spark):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash", "suffixes", "packing"]
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.where(F.col("length") > 2048).count() == 0 and rows.count() > 0


CLASHING = ("_score", "_sentence", "_first", "_windows", "_text_hash", "_kept_id", "_row", "digest", "id", "ids", "rows", "stays",
            "component", "text_hash", "head", "piece", "sequence_id", "n_chars")


@pytest.mark.parametrize("some", [True, False])
def test_pipeline_stages_on_awkward_rows(spark, awkward, none, some):
    """Nulls, repeats, two rows of one id and columns named like those that the stages make, or no rows at all."""
    import corpus_pipeline

    docs = (awkward if some else none).select("*", *[F.lit(i).alias(n) for i, n in enumerate(CLASHING)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == ["doc_id", "text", "component_id", "shard", *CLASHING]
    rows = docs.collect()
    assert all(r[n] == i for r in rows for i, n in enumerate(CLASHING[:-1]))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows}
    # Text 1 stands for 2, 3 and 12; repeats of 8 become one; a row without an id is never a copy.
    assert {r.doc_id for r in rows} == ({None, 1, 4, 5, 6, 7, 9, 10, 11} if some else set())
