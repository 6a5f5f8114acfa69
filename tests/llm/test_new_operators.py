"""Vector codes, licence scans and importance resampling against plain Python and on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.llm import codes, licences, queries, resampling

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, label int, code string, error string"
NAN, INF = float("nan"), float("inf")


def plain_codes(rows, parts, entries, rounds):
    """Every part compared with every entry in each round."""
    kept = [(i, v, label) for i, v, label, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    cut = []
    for i, v, label in kept:
        whole = [math.floor(4096 * float(np.float32(x))) for x in v] + [0] * (width * parts - len(v))
        cut.append((i, label, [tuple(whole[p * width:(p + 1) * width]) for p in range(parts)], v))
    first = sorted(cut, key=lambda r: (r[0] is None, r[0] or 0, r[3]))[:entries]
    book = [[r[2][p] for r in first] for p in range(parts)]

    def nearest(x, entries_):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(entries_))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for r in cut:
                members.setdefault(nearest(r[2][p], book[p])[1], []).append(r[2][p])
            for e, xs in members.items():
                book[p][e] = tuple(sum(column) // len(xs) for column in zip(*xs, strict=True))
    found = [(i, label, [nearest(x, book[p]) for p, x in enumerate(xs)]) for i, label, xs, _ in cut]
    by_label = Counter()
    for _, label, near in found:
        by_label[label] += sum(d for d, _ in near)
    digest = hashlib.sha256(",".join(str(x) for part in book for c in part for x in c).encode()).hexdigest()
    return sorted((str(i), "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near), by_label[label], digest)
                  for i, label, near in found)


def coded(df, **options):
    return sorted((str(r.vec_id), r.code, r["error"], r.label_error, r.codebooks_sha256)
                  for r in codes.vector_codes(df, **options).collect())


def test_codes_equal_plain_rounds(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice((-0.5, 0.0, 0.25, draw.gauss(0, 1))) for _ in range(16)], i % 3 or None, "x", None) for i in range(80)]
    rows += rows[:3] + [
        (200, None, 1, None, None), (201, [1.0] * 15 + [None], 1, None, None), (202, [NAN] * 16, 1, None, None), (203, [INF] * 16, 2, None, None),
        (None, [0.5] * 16, 1, None, None), (3, [0.125] * 16, 7, None, None), (204, [], 9, None, None), (205, [1.0] * 9, None, None, None),
        (206, [-100.0] * 16, 1, None, None)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    for parts, entries, rounds in ((8, 16, 6), (4, 5, 3), (8, 16, 0), (2, 256, 2)):
        assert coded(df, parts=parts, entries=entries, rounds=rounds) == plain_codes(rows, parts, entries, rounds)


def test_codes_of_few_or_no_rows(spark):
    rows = [(2, [1.0] * 8, None, None, None), (1, [0.0] * 8, None, None, None)]
    assert coded(spark.createDataFrame(rows, VECTORS)) == plain_codes(rows, 8, 16, 6)
    assert coded(spark.createDataFrame([], VECTORS)) == []
    assert coded(spark.createDataFrame([(1, None, 1, None, None)], VECTORS)) == []
    with pytest.raises(ValueError):
        codes.vector_codes(spark.createDataFrame(rows, VECTORS), entries=257)


def test_only_moved_entries_are_compared():
    """The shortcut gives what a whole scan gives, with many ties."""
    draw = np.random.default_rng(3)
    before = draw.integers(-2, 3, (1, 8, 2))
    matrix = draw.integers(-3, 4, (400, 2)).astype(np.int32)
    index, best = codes.assign(matrix, before)
    after = before.copy()
    after[0, [1, 6]] = draw.integers(-2, 3, (2, 2))
    moved = (after != before).any(axis=2)
    short = codes.assign(matrix, after, moved, index, best)
    whole = codes.assign(matrix, after)
    assert all((a == b).all() for a, b in zip(short, whole, strict=True)) and moved.any()


def test_codes_approximate_the_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    found, book = codes.compress(df)
    both = codes.decode(found, book).join(df, F.col("id") == F.col("vec_id"))
    far = both.select(F.expr("aggregate(zip_with(approximation, embedding, (a, b) -> (a - b) * (a - b)), 0D, (s, x) -> s + x)").alias("d"),
                      "error").collect()
    assert len(far) == df.count() and all(abs(r.d * 4096 ** 2 - r["error"]) <= 64 * 600 for r in far)


EXPRESSIONS = [
    ("MIT", "mit", {"mit"}, True), ("MIT OR GPL-2.0-only AND Apache-2.0", "mit or gpl-2.0-only and apache-2.0", {"mit", "gpl", "apache"}, True),
    ("(MIT OR GPL-2.0-only) AND LGPL-2.1+", "(mit or gpl-2.0-only) and lgpl-2.1+", {"mit", "gpl", "lgpl"}, False),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", "gpl-2.0-or-later with classpath-exception-2.0", {"gpl"}, False),
    ("MIT/Apache-2.0", "mit or apache-2.0", {"mit", "apache"}, True), ("MIT and the rest", "mit", {"mit"}, True), ("MIT.", "mit", {"mit"}, True),
    ("MIT OR (BSD-3-Clause", "mit", {"mit"}, True), ("((ISC))", "isc", {"isc"}, True), ("Apache-2.0 */", "apache-2.0", {"apache"}, True),
    ("MIT AND GPL-3.0 AND BSD-2-Clause", "mit and gpl-3.0 and bsd-2-clause", {"mit", "gpl", "bsd"}, False),
    ("MIT WITH", "mit", {"mit"}, True), ("MIT WITH nothing", "mit", {"mit"}, True),
]


@pytest.mark.parametrize("written,text,labels,permitted", EXPRESSIONS)
def test_expressions(written, text, labels, permitted):
    verdict = licences.evaluate(licences.parse(written.encode()))
    assert (verdict.text, set(verdict.labels), verdict.permitted) == (text, labels, permitted)


@pytest.mark.parametrize("written", ["", "see below", "OR MIT", "(MIT", "()", "WITH llvm-exception", ") MIT", "mitten", "gplx-2.0"])
def test_no_expression(written):
    assert licences.parse(written.encode()) is None


def test_expressions_equal_pythons_reading():
    """Random trees: ``and`` and ``or`` bind as in Python, so its evaluation of the same line decides alike."""
    draw = random.Random(1)
    for _ in range(300):
        def tree(depth):
            if not depth or draw.random() < 0.3:
                return draw.choice(["mit", "gpl-2.0", "apache-2.0", "lgpl-3.0+"])
            inner = f"{tree(depth - 1)} {draw.choice(['and', 'or'])} {tree(depth - 1)}"
            return f"({inner})" if draw.random() < 0.5 else inner
        line = tree(4)
        want = eval(re.sub(r"[a-z][a-z0-9.+-]+", lambda m: m[0] if m[0] in ("and", "or") else str(m[0] in ("mit", "apache-2.0")), line))  # noqa: S307
        first = licences.evaluate(licences.parse(line.encode()))
        again = licences.evaluate(licences.parse(first.text.encode()))
        assert first.permitted is want and again == first


def base_places(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [(i, label) for phrase, label in licences.BASE.items() for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in found})))


LICENSED = [
    (1, "The MIT License, MIT-license; mit\nlicense", "x"), (2, None, None), (3, "", None), (4, "¡MIT License", "x"), (5, "MIT  LICENSES Apache_License", None),
    (6, "// SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note\ncode", None), (7, "SPDX-License-Identifier: nonsense", None),
    (8, '{"license": "BSD-3-Clause OR MIT"}', None), (9, "license: see below", None), (10, "mit license " * 3000, None),
    (10, "mit license " * 3000, None), (None, "GNU Lesser General Public License", None), (11, "...\n\t", None), (12, "é" * 5000 + " apache license", None),
]


def test_licences_on_awkward_rows(spark):
    df = spark.createDataFrame(LICENSED, "doc_id bigint, text string, labels string")
    got = {r.doc_id: r for r in licences.scan(df).collect()}
    assert licences.scan(df).count() == len(LICENSED)
    for doc, text, _ in LICENSED:
        r = got[doc]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_places(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[6].labels == "gpl" and got[6].permitted is False and got[6].expressions == ["gpl-2.0-only with linux-syscall-note"]
    assert got[7].labels == "" and got[7].score == pytest.approx(0.2) and got[7].permitted is None
    assert got[8].labels == "bsd,mit" and got[8].permitted is True
    assert got[9].labels == "" and got[9].score == 0 and got[2].score == 0
    assert got[None].labels == "gpl,lgpl"
    assert licences.scan(df.where("false")).count() == 0
    spots = {(r.doc_id, r.word, r.label) for r in licences.locate(df).where("doc_id < 10 or doc_id is null").collect()}
    assert spots == {(1, 1, "mit"), (1, 3, "mit"), (1, 5, "mit"), (5, 2, "apache"), (None, 1, "lgpl"), (None, 2, "gpl")}


def test_licences_equal_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op12_licences(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts) and any(r.n_base for r in got)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_places(texts[r.doc_id])


def plain_resampling(docs, target, longest, percent, least, buckets, seed):
    def grams(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        return len(words), [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    def bucket(gram):
        return zlib.crc32(gram.encode()) % buckets

    s, t = (Counter(bucket(g) for text in side for g in grams(text)[1]) for side in ([d[1] for d in docs], target))
    out = []
    for doc, text, *_ in docs:
        n_words, own = grams(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in map(bucket, own)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, n_words, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[:percent * len(able) // 100], 1):
        r[5] = rank
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("longest,percent,least", [(1, 10, 20), (3, 50, 2), (2, 100, 0), (1, 0, 1)])
def test_resampling_equals_plain_python(spark, longest, percent, least, monkeypatch):
    draw = random.Random(longest)
    words = ["Alpha", "beta", "GAMMA", "naïve", "漢字", "x1", "d'or", "two-part"]
    docs = [(i, " ".join(draw.choices(words, k=draw.randrange(40))), None) for i in range(120)]
    docs += [docs[7]] * 40 + [(500, None, 3), (501, "", None), (502, "... \n", None), (None, "beta beta x1", 1), (None, "beta beta x1", 1), (503, "w" * 5000, None)]
    target = ["x1 x1 beta", None, "naïve Alpha two"]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, score int").repartition(3)
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, rank int")
    monkeypatch.setattr(resampling, "CHUNK", 50)
    got = resampling.resample(df, goal, longest, percent, least, 97).collect()
    assert sorted(map(tuple, got), key=str) == plain_resampling(docs, target, longest, percent, least, 97, 2024)


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two", None)], "doc_id bigint, text string, rank int")
    assert resampling.resample(docs.where("false"), docs).count() == 0
    assert resampling.resample(docs, docs.where("false"), least_words=1, percent=100).first()["rank"] == 1


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(resampling, "SLICE", 7)
    text = b"aa bb  cc dddddddddddd e ff"
    assert [w for words in resampling.word_lists(text) for w in words] == text.split()
    runs = [g for _, part in resampling.features(text, 3) for g in part]
    words = text.split()
    assert sorted(runs) == sorted(b" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))


@pytest.mark.parametrize("key", [lambda g: 0, len, lambda g: zlib.crc32(g) % 5])
def test_interning_verifies_bytes(key):
    """Equal keys of different n-grams end in different slots."""
    draw = random.Random(2)
    grams = [bytes(draw.choices(b"abc", k=draw.randrange(1, 4))) for _ in range(500)]
    table = resampling.NgramTable(grams, 11, key)
    assert len({(g, s) for g, s in zip(grams, table.slot.tolist(), strict=True)}) == len(set(grams)) == len(set(table.slot.tolist()))
    assert table.bucket_counts(11).tolist() == [sum(zlib.crc32(g) % 11 == b for g in grams) for b in range(11)]
    gains = np.arange(11)
    assert table.gather(gains).tolist() == [zlib.crc32(g) % 11 for g in grams]
