"""Training, encoding and decoding against the public tokenizers library."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library
from tokenizers import decoders, models, pre_tokenizers, trainers

from tokenloom.constants import SPECIAL_TOKENS
from tokenloom.functions.text import pieces
from tokenloom.operators import bpe, codec
from tokenloom.sources import tokenizer_files

SIZE = 420


def library(texts, size=SIZE):
    lib = Library(models.BPE(unk_token="<UNK>"))
    lib.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    lib.decoder = decoders.ByteLevel()
    lib.train_from_iterator(texts, trainers.BpeTrainer(
        vocab_size=size, min_frequency=2, show_progress=False,
        initial_alphabet=pre_tokenizers.ByteLevel.alphabet(),
        special_tokens=list(SPECIAL_TOKENS)))
    return lib


@pytest.fixture(scope="module")
def corpus(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").cache()


@pytest.fixture(scope="module")
def both(corpus, texts):
    plain = [t for t in texts if "<" not in t]
    words = bpe.word_counts(corpus.filter(~F.col("text").contains("<")))
    return bpe.bpe_train(words, SIZE), library(plain)


def test_pieces_match(corpus, texts):
    split = pre_tokenizers.ByteLevel(add_prefix_space=True)
    got = {r.doc_id: r.p for r in corpus.select("doc_id", pieces(F.col("text")).alias("p")).collect()}
    spell = dict(zip(map(chr, range(256)), bpe.byte_alphabet()))
    for i, text in enumerate(texts):
        want = [p for p, _ in split.pre_tokenize_str(text)]
        assert ["".join(spell[chr(b)] for b in p.encode()) for p in got[i]] == want, repr(text)


def test_training_matches(both):
    mine, lib = both
    assert {r.token: r.id for r in mine.vocab.collect()} == lib.get_vocab()


def test_training_stops_at_min_frequency(spark):
    words = spark.createDataFrame([("ab", 2), ("cd", 1)], "piece string, n bigint")
    merges = bpe.bpe_train(words, 400).merges.collect()
    assert len(merges) == 1


def test_self_pairs_match(spark):
    texts = ["aaaaa aaa bbbbbbb", "aaaa abab ababab", "bb aabb aa abba"]
    words = bpe.word_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    mine = bpe.bpe_train(words, 300)
    assert {r.token: r.id for r in mine.vocab.collect()} == library(texts, 300).get_vocab()


def one_at_a_time(words, tokens, size):
    """Brute force: recount everything, merge one pair, repeat."""
    words = [([tokens.index(c) for c in w], n) for w, n in words]
    merges = []
    while len(tokens) < size:
        counts = {}
        for ids, n in words:
            for pair in zip(ids, ids[1:]):
                counts[pair] = counts.get(pair, 0) + n
        if not counts or max(counts.values()) < 2:
            break
        pair = min(counts, key=lambda p: (-counts[p], p))
        token = tokens[pair[0]] + tokens[pair[1]]
        if token not in tokens:
            tokens.append(token)
        merges.append((*pair, tokens.index(token)))
        for ids, _ in words:
            i = 0
            while i < len(ids) - 1:
                if (ids[i], ids[i + 1]) == pair:
                    ids[i:i + 2] = [tokens.index(token)]
                i += 1
    return merges


def test_batched_merges_equal_one_at_a_time():
    """Batches chosen by ``merge_batch``, applied by plain replace, on random words."""
    import random

    for seed in range(60):
        rng = random.Random(seed)
        words = [("".join(rng.choices("abcd", k=rng.randint(1, 9))), rng.randint(1, 9))
                 for _ in range(rng.randint(2, 25))]
        want = one_at_a_time(words, list("abcd"), 30)
        tokens, got, top = list("abcd"), [], rng.choice([3, 1000])
        state = [("".join(bpe.symbol(tokens.index(c)) for c in w), n) for w, n in words]
        number = {bpe.symbol(i): i for i in range(40)}
        while len(tokens) < 30:
            counts = {}
            for w, n in state:
                for pair in map("".join, zip(w, w[1:])):
                    counts[pair] = counts.get(pair, 0) + n
            ranked = sorted(((p, n) for p, n in counts.items() if n >= 2), key=lambda x: (-x[1], x[0]))
            if not ranked:
                break

            def joined(pair):
                return "".join(tokens[number[s]] for s in pair)

            for pair in bpe.merge_batch(ranked[:top], len(ranked) <= top - 1, 30 - len(tokens),
                                        tokens.__contains__, joined):
                if joined(pair) not in tokens:
                    tokens.append(joined(pair))
                new = tokens.index(joined(pair))
                got.append((number[pair[0]], number[pair[1]], new))
                state = [(w.replace(pair, bpe.symbol(new)), n) for w, n in state]
        assert got == want, seed


def test_two_thousand_merges_match(spark):
    """One count of all pairs, and the library's vocabulary."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    size, report = len(bpe.base_tokens()) + 2000, {}
    mine = bpe.learn_merges(bpe.byte_words(bpe.word_counts(docs)), bpe.base_tokens(), size, report=report)
    lib = library([r.text for r in docs.select("text").collect()], size)
    assert {r.token: r.id for r in mine.vocab.collect()} == lib.get_vocab()
    assert report["counts"] == 1 and report["rounds"] < 1000


@pytest.mark.parametrize("listed,settled", [(3, 4), (12, 7)])
def test_short_lists_and_rewritten_words_change_nothing(spark, listed, settled, monkeypatch):
    """Counting anew whenever the list runs out, and writing the words anew, keep the merges."""
    import random

    rng = random.Random(listed)
    texts = [" ".join("".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(60))]
    words = bpe.word_counts(spark.createDataFrame([(t,) for t in texts], "text string")).cache()
    monkeypatch.setattr(bpe, "LISTED_PAIRS", listed)
    monkeypatch.setattr(bpe, "SETTLE_MERGES", settled)
    report = {}
    mine = bpe.learn_merges(bpe.byte_words(words), bpe.base_tokens(), 295, report=report)
    assert {r.token: r.id for r in mine.vocab.collect()} == library(texts, 295).get_vocab()
    assert report["counts"] > 1


def test_a_round_touches_only_words_with_a_merged_pair(spark):
    """Gains and losses are those of the words that hold the pair."""
    a, b, c, d, x, y = map(bpe.symbol, range(6))
    state = bpe.Words(spark.createDataFrame([(a + b + c, 5), (c + b + a, 7), (a + b + a + b, 2), (a, 9)], "word string, n bigint"))
    try:
        assert state.merge([(a + b, x)]) == {a + b: -9, b + c: -5, b + a: -2, x + c: 5, x + x: 2}
        assert state.merge([(x + c, y)]) == {x + c: -5}
        assert sorted(map(tuple, state.merged().collect())) == sorted([(y, 5), (c + b + a, 7), (x + x, 2)])
        assert state._spelled(y) == a + b + c and d not in state.spelling
    finally:
        state.drop()


@pytest.mark.parametrize("prefix", [True, False])
def test_encoding_matches(corpus, texts, both, prefix):
    mine, lib = both
    lib.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=prefix)
    rows = codec.encode(corpus, mine, add_prefix_space=prefix).select("doc_id", "ids").collect()
    for row in rows:
        want = lib.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.ids == want, repr(texts[row.doc_id])


@pytest.mark.parametrize("skip", [True, False])
def test_decoding_matches(corpus, texts, both, skip):
    mine, lib = both
    encoded = codec.encode(corpus, mine).select("doc_id", "ids")
    for row in codec.decode(encoded, mine, skip_special_tokens=skip).collect():
        assert row.text == lib.decode(row.ids, skip_special_tokens=skip)
        if not skip:
            assert row.text == texts[row.doc_id]


def test_broken_utf8_is_replaced(spark, both):
    tok = both[0]
    half = spark.createDataFrame([([98 + 60],)], "ids array<int>")
    assert "�" in codec.decode(half, tok).first().text


def test_null_and_empty_rows(spark, both):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "ab")], "k int, text string")
    found = {r.k: r.ids for r in codec.encode(rows.coalesce(1), both[0]).collect()}
    assert found[1] is None and found[2] == [] and found[3]


def test_saved_tokenizer_loads_in_the_library(both, tmp_path, corpus, texts):
    mine, lib = both
    tokenizer_files.write_tokenizer(mine, str(tmp_path / "tok"))
    part = next((tmp_path / "tok" / "tokenizer.json").glob("part-*"))
    loaded = Library.from_str(part.read_text())
    lib.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    for text in texts[:60]:
        if "<" not in text:
            assert loaded.encode(text).ids == lib.encode(text, add_special_tokens=False).ids


def test_wordpiece_units_cross_spaces(spark):
    rows = [("to be or not to be",)] * 3 + [("to be",)] * 2
    tok = bpe.wordpiece_train(spark.createDataFrame(rows, "text string"), size=290)
    names = {r.token for r in tok.vocab.collect()}
    assert {"t", "##o", "## "} <= names
    assert any(" " in n.removeprefix("##").strip() for n in names)
    assert "to be or not to be" in {
        r.token for r in bpe.wordpiece_train(spark.createDataFrame(rows, "text string")).vocab.collect()}


def test_wordpiece_size_matches_library(spark, texts):
    plain = [line for t in texts[40:80] for line in t.split("\n")]
    lib = Library(models.WordPiece(unk_token="<UNK>"))
    lib.train_from_iterator(plain, trainers.WordPieceTrainer(
        vocab_size=390, min_frequency=2, show_progress=False,
        initial_alphabet=pre_tokenizers.ByteLevel.alphabet(),
        special_tokens=list(SPECIAL_TOKENS)))
    mine = bpe.wordpiece_train(spark.createDataFrame([(t,) for t in plain], "text string"), size=390)
    assert {r.token for r in mine.vocab.collect()} == set(lib.get_vocab())


UNITS = ["", "to be", "to be or not", "<s>to be</s> or<mask>", "x" * 101, "to be" * 20, "  to", "漢to", "##be", "to\nbe", None]


@pytest.fixture(scope="module")
def wordpiece(spark, texts):
    rows = [("to be or not to be",)] * 4 + [("to be",)] * 2 + [("not be 漢 #x  bet",)] * 3
    mine = bpe.wordpiece_train(spark.createDataFrame(rows, "text string"), size=300)
    lib = Library(models.WordPiece(vocab={r.token: r.id for r in mine.vocab.collect()}, unk_token="<unk>"))
    lib.add_special_tokens(list(SPECIAL_TOKENS))
    return mine, lib


def test_wordpiece_encoding_matches(spark, wordpiece):
    mine, lib = wordpiece
    df = spark.createDataFrame(list(enumerate(UNITS)), "k int, text string")
    found = {r.k: r.ids for r in codec.encode(df, mine).collect()}
    for k, text in enumerate(UNITS):
        assert found[k] == (None if text is None else lib.encode(text, add_special_tokens=False).ids), text
    assert any(3 in (ids or []) for ids in found.values())


@pytest.mark.parametrize("skip", [True, False])
def test_wordpiece_decoding_matches(spark, wordpiece, skip):
    mine, lib = wordpiece[0], Library.from_str(wordpiece[1].to_str())
    df = codec.encode(spark.createDataFrame(list(enumerate(UNITS[:4] + UNITS[6:7])), "k int, text string"), mine).drop("text")
    known = {r.k: r.ids for r in df.collect()}
    for style, decoder in (("tokens", None), ("words", decoders.WordPiece(cleanup=False))):
        if decoder:
            lib.decoder = decoder
        if decoder:
            lib.decoder = decoder
        for r in codec.decode(df, mine, skip_special_tokens=skip, style=style).collect():
            assert r.text == lib.decode(known[r.k], skip_special_tokens=skip)
    for r in codec.decode(df, mine, skip_special_tokens=False).collect():
        assert r.text == (UNITS[:4] + UNITS[6:7])[r.k]
    with pytest.raises(ValueError):
        codec.decode(df, mine, style="other")


def test_longest_match_equals_the_library():
    import random

    from tokenloom.operators.wordpiece import LongestMatch

    rng = random.Random(1)
    for _ in range(100):
        names = ["<unk>", *sorted({("##" if rng.random() < 0.6 else "") + "".join(rng.choices("ab#c", k=rng.randint(1, 5)))
                                   for _ in range(rng.randint(1, 25))})]
        lib = Library(models.WordPiece(vocab={t: i for i, t in enumerate(names)}, unk_token="<unk>"))
        match = LongestMatch(names)
        for _ in range(30):
            text = "".join(rng.choices("abc#", k=rng.randint(0, 12)))
            found = match(text)
            assert ([0] if found is None else found) == lib.encode(text).ids


def test_the_wrong_kind_is_an_error(spark, both, wordpiece):
    with pytest.raises(ValueError, match="BPE tokenizer is needed"):
        codec.piece_encoder(wordpiece[0])
    with pytest.raises(ValueError, match="WordPiece tokenizer is needed"):
        codec.wordpiece_encoder(both[0], 100, SPECIAL_TOKENS)


def tables(tok):
    """A WordPiece file holds no merges."""
    merges = sorted(map(tuple, tok.merges.collect())) if tok.kind == "BPE" else None
    return (sorted(map(tuple, tok.vocab.collect())), merges, tok.kind, tok.specials, tok.unknown, tok.prefix)


@pytest.mark.parametrize("kind", ["BPE", "WordPiece"])
def test_json_layout_round_trip(spark, both, wordpiece, tmp_path, kind):
    """Our export loads in the library, and the library's own file reads back to the same tokenizer."""
    mine = both[0] if kind == "BPE" else wordpiece[0]
    path = tokenizer_files.write_tokenizer(mine, str(tmp_path / "tok"))
    saved = tokenizer_files.read_tokenizer(spark, path)
    assert tables(saved) == tables(mine) and saved.merges.count() == mine.merges.count()
    assert tables(tokenizer_files.read_tokenizer_json(spark, f"{path}/tokenizer.json")) == tables(mine)
    loaded = Library.from_str(next((tmp_path / "tok" / "tokenizer.json").glob("part-*")).read_text())
    loaded.save(str(tmp_path / "library.json"))
    assert tables(tokenizer_files.read_tokenizer_json(spark, str(tmp_path / "library.json"))) == tables(mine)


def test_foreign_tokenizer_file(spark, corpus, texts):
    """A public byte-level file encodes as the library does; other kinds are refused."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, lib = tokenizer_files.read_tokenizer_json(spark, path), Library.from_file(path)
    for row in codec.encode(corpus, tok).select("doc_id", "ids").collect():
        assert row.ids == lib.encode(texts[row.doc_id], add_special_tokens=False).ids, repr(texts[row.doc_id])
    with pytest.raises(ValueError):
        tokenizer_files.read_tokenizer_json(spark, public_tokenizers.path("word_bpe_49k.json"))


def test_laid_merges_equal_plain_replace():
    """Merges of words end to end, and the changes of the counts, against str.replace and plain counts."""
    import random
    from collections import Counter

    import pyarrow as pa

    def counted(words):
        found = Counter()
        for w, n in words:
            for a, b in zip(w, w[1:]):
                found[bpe.pair_key(a + b)] += n
        return found

    for seed in range(40):
        rng = random.Random(seed)
        words = [("".join(rng.choices("abc\U0001F600", k=rng.randint(1, 12))), rng.randint(1, 9)) for _ in range(rng.randint(1, 30))]
        codes, weights = bpe.lay(pa.array([w for w, _ in words]), pa.array([n for _, n in words]))
        for k in range(6):
            pair, made = "".join(rng.choices("abc\U0001F600xy", k=2)), "xyzuvw"[k]
            before = counted(words)
            words = [(w.replace(pair, made), n) for w, n in words]
            codes, weights, keys, changes = bpe.merge_laid(codes, weights, pair, made)
            assert codes.astype("<u4").tobytes().decode("utf-32-le").split("\0")[1:-1] == [w for w, _ in words]
            after = counted(words)
            want = {p: after[p] - before[p] for p in before | after if after[p] != before[p]}
            assert {p: d for p, d in zip(keys.tolist(), changes.tolist()) if d} == want


def test_a_round_takes_many_merges_of_whole_lines(spark):
    """Lines of words share most pairs, so that merges touch each other; a round takes them one after the other all the same."""
    rows = [(" ".join(f"{a}{b}" for a in ("ne", "so", "ti") for b in ("ra", "lu", "ko", str(i % 7))[: 2 + i % 3]), 3 + i % 5) for i in range(60)]
    tokens = sorted({c for text, _ in rows for c in text})
    spelled = [("".join(bpe.symbol(tokens.index(c)) for c in text), n) for text, n in rows]
    want = one_at_a_time(rows, list(tokens), len(tokens) + 30)
    report = {}
    mine = bpe.learn_merges(spark.createDataFrame(spelled, "word string, n bigint"), tokens, len(tokens) + 30, report=report)
    assert [(m.left, m.right, m.new_id) for m in mine.merges.orderBy("rank").collect()] == want
    assert len(want) >= 30 and report["rounds"] <= 6


def test_batches_of_long_texts_are_encoded_in_parts(spark, monkeypatch):
    """No part holds more than its bound of bytes but for a single row; null and empty rows keep their place."""
    import pyarrow as pa

    monkeypatch.setattr(codec, "PART_BYTES", 40)
    lists = pa.array([["a" * 30], None, [], ["b"] * 9, ["c" * 90], ["é"] * 15, ["d"], None])
    parts = list(codec._bounded_parts(lists.slice(0, 8)))
    assert pa.concat_arrays(parts).to_pylist() == lists.to_pylist() and len(parts) == 3
    assert all(len(p) == 1 or sum(len(w.encode()) for row in p.to_pylist() for w in row or []) <= 40 for p in parts)
    assert list(codec._bounded_parts(lists.slice(0, 0))) == []
    monkeypatch.undo()
    rows = [(i, None if i == 3 else "" if i == 4 else "né " * (40_000 * i)) for i in range(9)] + [(9, "x" * 3_000_000)]
    texts = spark.createDataFrame(rows, "k int, text string").coalesce(1)
    sizes = {r.k: r.n for r in codec.encode(texts, bpe.byte_tokenizer(spark)).select("k", F.size("ids").alias("n")).collect()}
    assert sizes == {k: None if t is None else len(t.encode()) for k, t in rows}


def _uncut(rows, monkeypatch, **how):
    """The vocabulary learned from whole units."""
    with monkeypatch.context() as m:
        def whole(cuts, least):
            cuts.least = cuts.min_frequency
            return bpe._fragments(cuts.lines, cuts.symbols, None)

        m.setattr(bpe._Cuts, "words", whole)
        m.setattr(bpe, "CUT_MERGES", 1 << 30)
        return bpe.wordpiece_train(rows, **how)


@pytest.mark.parametrize("alphabet, share, after", [("abcdefgh ", 0.8, 5), ("a##", 3.0, 1), ("é漢😀a ", 3.0, 2)])
def test_wordpiece_trains_on_fragments_as_on_whole_units(spark, monkeypatch, alphabet, share, after):
    """A bound that is foretold too high makes it cut anew; with "#" tokens come again."""
    r = random.Random(len(alphabet))
    units = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(80)]
    rows = spark.createDataFrame([(u,) for u in [*units, None, ""]], "text string").coalesce(2)
    whole = _uncut(rows, monkeypatch, size=300)
    monkeypatch.setattr(bpe, "FORETOLD_SHARE", share)
    monkeypatch.setattr(bpe, "CUT_MERGES", after)
    mine = bpe.wordpiece_train(rows, size=300)
    assert mine.vocab.collect() == whole.vocab.collect()
    assert mine.merges.collect() == whole.merges.collect() != []


def test_wordpiece_keeps_no_whole_units(spark, monkeypatch):
    """Long units that are all different are cut where neighbours are rare, and their fragments repeat."""
    r = random.Random(8)
    units = [" ".join(r.choice(["the", "cat", "sat", f"{r.randrange(10**6)}"]) for _ in range(40)) for _ in range(200)]
    longest = []

    class Seen(bpe.Words):
        def __init__(self, words):
            longest.append(words.agg(F.max(F.length("word"))).first()[0] or 0)
            super().__init__(words)

    monkeypatch.setattr(bpe, "Words", Seen)
    bpe.wordpiece_train(spark.createDataFrame([(u,) for u in units], "text string"), size=290)
    assert longest[0] < min(map(len, units)) / 2


def test_wordpiece_encodes_fragments_as_whole_units(spark):
    from tokenloom.functions.fragments import Joints
    from tokenloom.functions.text import segments
    from tokenloom.operators.wordpiece import LongestMatch

    names = [*SPECIAL_TOKENS, "a", "b", "<", "s", "##a", "##b", "##é", "##s", "##>", "ab", "##ba", "##b#", "aé😀", "##😀a", "##<s"]
    tok = bpe.Tokenizer(spark.createDataFrame(list(enumerate(names)), "id int, token string"),
                        spark.createDataFrame([], "rank int, left int, right int, new_id int"), kind=bpe.WORDPIECE)
    r = random.Random(9)
    parts = ["a", "b", "a", "b", "#", "é", "😀", "<s>", "</s>", "<mask>", "<", "s", ">", "0"]
    rows = [("".join(r.choice(parts) for _ in range(r.randrange(9))),) for _ in range(500)] + [(None,), ("",)]
    df = spark.createDataFrame(rows, "text string").coalesce(3)
    match, unknown = LongestMatch(names), names.index(tok.unknown)
    for specials in (SPECIAL_TOKENS, ()):
        for most in (5, 100):
            got = codec.encode(df, tok, specials=specials, max_chars=most)
            for row in got.withColumn("segments", segments(F.col("text"), specials)).collect():
                want = None if row.text is None else []
                for s in row.segments or ():
                    found = [names.index(s)] if s in specials else match(s) if len(s) <= most else None
                    want += [unknown] if found is None else found
                assert row.ids == want, row.text
    pairs = [(ord(x), ord(y)) for name in names for x, y in zip(name, name[1:])]
    joints = Joints(*(np.array(side, np.int32) for side in zip(*pairs)))
    found, heads, chars, per_row = codec._fragments(pa.array(["abbbab", None, "ss<s>a"]), joints, SPECIAL_TOKENS)
    assert found.to_pylist() == ["0ab", "1b", "1bab", "0s", "1s", "0<s>", "0a"]
    assert heads.sum() == 4 and chars.tolist() == [6, 2, 3, 1] and per_row.tolist() == [3, 0, 4]
