"""The queries that SQL cannot express, over the whole smallest tables, against plain Python."""

import base64
import hashlib
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
from test_minhash import brute, shingles

import corpus_pipeline
from tokenloom.llm import queries, tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_op1_minhash(spark, docs):
    got, want = by_id(queries.op1_minhash(spark, SF)), brute(list(docs.items()))
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.n_shingles == len(shingles(docs[i])) and r.kept == (want[i] == i) for i, r in got.items())


def test_op2_packing(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op2_packing(spark, SF).collect():
        parts[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    total = 0
    for doc, text in docs.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        total += len(ids)
        rows = sorted(parts[doc], key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in rows] == [(k, 2048 * k) for k in range(-(-len(ids) // 2048))]
        for r in rows:
            own = ids[r.start:r.start + 2048]
            assert (r.length, r.ids_crc32) == (len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own)))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= 1.01 * -(-total // 2048) + 1


def test_op3_token_counts(spark, docs):
    count = tokens.UnigramCounter(tokens.zipf_vocabulary(queries.PIECE_MODEL), True)
    assert {i: r.n_tokens for i, r in by_id(queries.op3_token_counts(spark, SF)).items()} == {i: count(t) for i, t in docs.items()}


def test_op4_sharding(spark, docs):
    got = by_id(queries.op4_sharding(spark, SF))
    load, slots = defaultdict(int), defaultdict(list)
    for doc, text in docs.items():
        r, raw = got[doc], text.encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "bytes")
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert set(load) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) <= 1.02 * sum(load.values()) / 8


def test_op5_byte_bpe(spark, docs):
    import tiktoken

    lines = [line.split() for line in open(queries.BYTE_RANKS, "rb")]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines})
    for doc, r in by_id(queries.op5_byte_bpe(spark, SF)).items():
        ids = library.encode_ordinary(docs[doc])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[doc].encode()).hexdigest()


def test_op6_urls(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    for page, r in by_id(queries.op6_urls(spark, SF), "page_id").items():
        rest = (urls[page] or "").partition("://")[2]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:] if rest[cut:cut + 1] == "/" else ""
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
        fits = [(len(h + p), verdict, h + p) for verdict, h, p in queries.URL_RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (host, path) and r.verdict in ("allow", "block")
        if fits:
            _, verdict, rule = max(fits)
            assert (r.rule, r.verdict) == (rule, verdict)
        else:
            assert r.rule is None


def test_op7_pivots(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    unit = np.array([r.embedding for r in rows], np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    got = by_id(queries.op7_pivots(spark, SF), "vec_id")
    found = np.array([got[r.vec_id].n_links for r in rows])
    assert (found <= links).all() and found.sum() >= 0.9 * links.sum()


def test_op8_suffixes(spark, docs):
    got, first = by_id(queries.op8_suffixes(spark, SF)), {}
    for doc in sorted(docs):
        data = docs[doc].encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if first.setdefault(data[i:i + 50], doc) < doc:
                gone[i:i + 50] = b"\1" * 50
        r = got[doc]
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        assert (r.n_bytes, r.n_removed, r.kept_sha256) == (len(data), sum(gone), hashlib.sha256(kept).hexdigest())
        assert r.n_spans == len([1 for g in bytes(gone).split(b"\0") if g])


def plain_simhash(text):
    """One vote after the other."""
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    terms = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else [" ".join(words)] if words else []
    votes = [0] * 64
    for term in terms:
        weight, h = min(8, 1 + len(term) // 8), xxhash.xxh64_intdigest(term.encode(), 42)
        for i in range(64):
            votes[i] += weight if h >> i & 1 else -weight
    return sum(1 << i for i, v in enumerate(votes) if v > 0)


def test_op9_simhash(spark, docs):
    got, order = by_id(queries.op9_simhash(spark, SF)), sorted(docs)
    prints = defaultdict(set)
    for doc, after in zip(order, [*order[1:], order[0]], strict=True):
        r, text, k = got[doc], docs[doc], len(docs[doc]) // 4
        edited = text[:len(text) - k] + docs[after][:k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints[text].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    numbers = {doc: int(r.fingerprint, 16) for doc, r in got.items()}
    assert all(n == plain_simhash(docs[doc]) for doc, n in numbers.items())
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()])


def test_op10_toxicity(spark, docs):
    marked = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = by_id(queries.op10_toxicity(spark, SF))
    assert set(got) == set(docs)
    for doc, r in got.items():
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    toxic, clean = ([got[d].score for d, y in marked.items() if y == want and d in got] for want in (1, 0))
    assert not toxic or not clean or np.mean(toxic) > np.mean(clean)


def test_pipeline_keeps_clean_documents(spark, docs):
    """The last stage packs what the others kept, and most documents are clean."""
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash", "suffixes", "packing"]
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} <= set(docs) and len({r.doc_id for r in rows}) > 0.6 * len(docs)
    assert all(r.length <= 2048 and len(r.ids) == r.length for r in rows)
