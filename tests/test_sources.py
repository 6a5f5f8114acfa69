"""Files in and out."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tokenloom.functions.text import strip_blank_lines
from tokenloom.operators import bpe, codec, ordering, packing
from tokenloom.plans.corpus import encode_folder, make_dataset, train_tokenizer
from tokenloom.sources import files, sentence_files, texts, tokens
from tokenloom.streaming.encode import encode_new_files


def test_line_order_and_missing_attribute(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join(json.dumps({"id": str(i), "text": f"t{i}"}) + "\n" for i in range(50)))
    rows = texts.read_jsonl_attr(spark, str(tmp_path / "a.jsonl")).orderBy("doc_id").collect()
    assert [r.text for r in rows] == [f"t{i}" for i in range(50)]
    assert {r.file for r in rows} == {"a.jsonl"}
    (tmp_path / "b.jsonl").write_text('{"id": "1"}\n')
    with pytest.raises(Exception, match="no attribute"):
        texts.read_jsonl_attr(spark, str(tmp_path / "b.jsonl")).collect()


def test_order_survives_many_splits(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join(json.dumps({"text": str(i)}) + "\n" for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = texts.read_jsonl_attr(spark, str(tmp_path / "a.jsonl"))
        assert df.rdd.getNumPartitions() > 1
        assert [int(r.text) for r in df.orderBy("doc_id").collect()] == list(range(2000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.fixture
def split_sizes(spark):
    """Several sizes of splits, small files packed many to a task and large ones cut."""
    def each():
        for size, cost in ((700, 10), (5000, 1), (1 << 27, 1 << 22)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", str(cost))
            yield size
    yield each
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_keys_are_line_numbers(spark, tmp_path, split_sizes):
    """0, 1, 2, ... in each file under every split size, with files of very different lengths in one task."""
    rng = random.Random(8)
    bodies = {f"f{k}": [f"{i}" + "x" * rng.choice([0, 3, 400]) for i in range(rng.choice([1, 2, 30, 300]))] for k in range(12)}
    for folder in ("jsonl", "lists", "matrix", "tags"):
        (tmp_path / folder).mkdir()
    for name, body in bodies.items():
        (tmp_path / "jsonl" / f"{name}.jsonl").write_text("".join(json.dumps({"text": t}) + "\n" for t in body))
        ids = [[len(t)] * (len(t) % 4) for t in body]
        (tmp_path / "lists" / f"{name}.jsonl").write_text("\n".join(map(json.dumps, ids)))
        (tmp_path / "matrix" / f"{name}.json").write_text(json.dumps(ids, indent=rng.choice([None, 1])) + "\n" * rng.choice([0, 900]))
        (tmp_path / "tags" / f"{name}.jsonl").write_text("".join(
            json.dumps({"token": [t], "ner": ["O"]}) + "\n" for t in body))
    splits = set()
    for _ in split_sizes():
        corpus = texts.read_jsonl_attr(spark, str(tmp_path / "jsonl"))
        splits.add(corpus.rdd.getNumPartitions())
        read = {(r.file, r.doc_id): r.text for r in corpus.collect()}
        assert read == {(f"{n}.jsonl", i): t for n, body in bodies.items() for i, t in enumerate(body)}
        lists = tokens.read_token_lists(spark, [str(tmp_path / "lists" / "f1*"), str(tmp_path / "lists" / "f[02-9].jsonl")])
        want = {(f"{n}.jsonl", i): [len(t)] * (len(t) % 4) for n, body in bodies.items() for i, t in enumerate(body)}
        assert {(r.file, r.doc_id): r.ids for r in lists.collect()} == want
        matrix = {(r.file, r.doc_id): r.ids for r in tokens.read_token_matrix(spark, str(tmp_path / "matrix")).collect()}
        assert matrix == {(f.replace("jsonl", "json"), i): ids for (f, i), ids in want.items()}
        tagged = texts.read_labelled(spark, str(tmp_path / "tags"))
        assert [r.token[0] for r in tagged.orderBy("sent_id").collect()] == [t for n in sorted(bodies) for t in bodies[n]]
        assert {r.sent_id for r in tagged.collect()} == set(range(sum(map(len, bodies.values()))))
    assert len(splits) > 1


def test_the_same_rows_are_test_rows_under_every_split_size(spark, tmp_path, split_sizes):
    (tmp_path / "t.jsonl").write_text("".join(
        json.dumps({"token": [f"w{i}"] * (i % 90), "ner": ["O"] * (i % 90)}) + "\n" for i in range(400)))
    chosen = {tuple(sorted(r.sent_id for r in ordering.split_fraction(
        texts.read_labelled(spark, str(tmp_path / "t.jsonl"))).where("split = 'test'").collect())) for _ in split_sizes()}
    assert len(chosen) == 1 and len(chosen.pop()) == 40


def test_labelled_lines_must_be_parallel(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"token": ["a", "b"], "ner": ["O"]}\n')
    with pytest.raises(Exception, match="no parallel lists"):
        texts.read_labelled(spark, str(tmp_path / "t.jsonl")).collect()


def test_encoded_parts_keep_line_order(spark, tmp_path):
    """Many read tasks, many part files of uneven size, and many tasks again."""
    rng = random.Random(3)
    sizes = [rng.choice([1, 2, 40]) if i % 500 < 250 else 1 for i in range(1500)]
    (tmp_path / "a.jsonl").write_text("".join(
        json.dumps({"text": f"{i} " + "x" * sizes[i]}) + "\n" for i in range(1500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        root = encode_folder(spark, str(tmp_path / "a.jsonl"), bpe.byte_tokenizer(spark), str(tmp_path))
        lists = tokens.read_token_lists(spark, root)
        assert lists.rdd.getNumPartitions() > 20
        rows = codec.decode(lists, bpe.byte_tokenizer(spark)).orderBy("doc_id").collect()
        assert len({r.doc_id for r in rows}) == 1500
        assert [int(r.text.split()[0]) for r in rows] == list(range(1500))
        (tmp_path / "m.json").write_text(json.dumps([[i] * (i % 7) for i in range(2000)]))
        matrix = tokens.read_token_matrix(spark, str(tmp_path / "m.json"))
        assert matrix.rdd.getNumPartitions() > 3
        assert [r.ids for r in matrix.orderBy("doc_id").collect()] == [[i] * (i % 7) for i in range(2000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_sentence_files_are_shared_between_tasks(spark, tmp_path, split_sizes):
    """Quotes, backslashes, brackets and names in the sentences, under every split size; damaged files are set aside."""
    rng = random.Random(4)
    awkward = ['', '"', '\\', '\\"', 'a\\\\', '], "sents": [', '{[', 'é\U0001f600', 'x\ny', '"sents"', 'sents', ': [', ',']
    bodies = {f"g{i}.json": [rng.choice(awkward) * rng.choice([1, 2, 30]) for _ in range(n)] for i, n in enumerate([0, 1, 2, 900])}
    for i, (name, sents) in enumerate(bodies.items()):
        whole = [{"sents": sents}, {"meta": {"sents": ["no"], "q": '\\"'}, "sents": sents, "n": [1, {"a": []}]}][i % 2]
        (tmp_path / name).write_text(json.dumps(whole, indent=[None, 1][i // 2], ensure_ascii=bool(i % 2)) + "\n")
    good = json.dumps({"sents": ["a", 'b"', "c\\"]})
    bad = {"cut": good[:-2], "open": good[:12], "trailing": good + " x", "two": good + good, "blank": " ", "other": '{"lines": ["a"]}', "plain": '"sents": ["a"]',
           "number": '{"sents": ["a", 1]}', "null": '{"sents": null}', "nested": '{"sents": [["a"]]}', "comma": '{"sents": ["a" "b"]}',
           "colon": '{"sents" ["a"]}', "deep": '{"m": {"sents": ["a"]}}', "escape": '{"sents": ["a\\q"]}', "control": '{"sents": ["a\tb"]}', "end": '{"sents": ["a",]}'}
    for name, body in bad.items():
        (tmp_path / f"{name}.json").write_text(body)
    for _ in split_sizes():
        sents, rejects, report = texts.read_tolerant(spark, str(tmp_path))
        assert {r.file for r in rejects.collect()} == {f"{name}.json" for name in bad}
        assert {(r.file, r.pos): r.sent for r in sents.collect()} == {(f, i): t for f, body in bodies.items() for i, t in enumerate(body)}
        assert tuple(report.first()) == (len(bad) + 4, sum(map(len, bodies.values())))


def test_matrix_dump_is_one_array_in_parts(spark, tmp_path):
    """Parts joined by name are one JSON array for each file, and read back with the same keys."""
    lists = {f"f{k}": [[i] * (i % 3) for i in range(n)] for k, n in enumerate([1, 2, 700])}
    rows = [(f, 5 * i, ids) for f, each in lists.items() for i, ids in enumerate(each)] + [("f3", 2, None), ("f3", 1, [7])]
    lists["f3"] = [[7], []]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "file string, doc_id bigint, ids array<int>").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        root = tokens.write_token_matrix(df, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = {f: sorted((tmp_path / "encoded" / f"file={f}").glob("part-*")) for f in lists}
    assert len(parts["f2"]) > 1
    assert {f: json.loads("".join(p.read_text() for p in each)) for f, each in parts.items()} == lists
    got = {(r.file, r.doc_id): r.ids for r in tokens.read_token_matrix(spark, root).collect()}
    assert got == {(f, i): ids for f, each in lists.items() for i, ids in enumerate(each)}


def test_tolerant_read(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps({"sents": ["x", "y"], "other": 1}, indent=1))
    (tmp_path / "cut.json").write_text('{"sents": ["x", "y"')
    (tmp_path / "none.json").write_text('{"lines": []}')
    (tmp_path / "empty.json").write_text('{"sents": []}')
    good, rejects, report = texts.read_tolerant(spark, str(tmp_path))
    assert [(r.pos, r.sent) for r in good.orderBy("pos").collect()] == [(0, "x"), (1, "y")]
    assert {r.file for r in rejects.collect()} == {"cut.json", "none.json"}
    assert report.first().asDict() == {"files": 4, "sentences": 2}
    with pytest.raises(Exception, match="no list"):
        texts.read_json_list_attr(spark, str(tmp_path / "none.json")).collect()


def test_hidden_files_are_an_error(spark, tmp_path):
    (tmp_path / "_encoded_a.jsonl").write_text("[1, 2]\n")
    with pytest.raises(files.NoInputFiles):
        tokens.read_token_lists(spark, str(tmp_path / "_encoded_a.jsonl"))
    with pytest.raises(files.NoInputFiles):
        tokens.read_token_lists(spark, str(tmp_path / "nowhere"))
    with pytest.raises(files.NoInputFiles):
        tokens.read_token_lists(spark, [])


@pytest.mark.parametrize("body", [
    [[1, 2], [], [3]], [[]], [], [[], []], [[7]],
])
@pytest.mark.parametrize("style", [{}, {"separators": (",", ":")}, {"indent": 2}])
def test_matrix_read(spark, tmp_path, body, style):
    (tmp_path / "m.json").write_text(json.dumps(body, **style))
    rows = tokens.read_token_matrix(spark, str(tmp_path / "m.json")).orderBy("doc_id").collect()
    assert [r.ids for r in rows] == body


def test_token_lists_keep_empty_rows(spark, tmp_path):
    df = spark.createDataFrame([("f", 0, [1, 2]), ("f", 1, []), ("g", 2, [3])],
                               "file string, doc_id bigint, ids array<int>")
    root = tokens.write_token_lists(df, str(tmp_path))
    rows = tokens.read_token_lists(spark, root).orderBy("file", "doc_id").collect()
    assert [(r.file, r.ids) for r in rows] == [("f", [1, 2]), ("f", []), ("g", [3])]
    assert packing.pack_none(df) is df


def test_select_and_list_files(spark, tmp_path):
    for name in ("a.jsonl", "b_encoded_.jsonl", "c.json"):
        (tmp_path / name).write_text("{}")
    listed = files.list_files(spark, str(tmp_path))
    names = {r.file for r in files.select_files(listed, ".jsonl", "_encoded_").collect()}
    assert names == {"a.jsonl"}
    assert {r.file for r in files.select_files(listed, suffix=".json").collect()} == {"c.json"}
    assert {r.file for r in files.select_files(listed, "_encoded_").collect()} == {"b_encoded_.jsonl"}


def test_blank_lines(spark):
    df = spark.createDataFrame([("a\n\n\nb",), ("a\n\nb\n\n",), ("a\nb",)], "t string")
    assert [r[0] for r in df.select(strip_blank_lines(F.col("t"))).collect()] == ["a\nb", "ab", "a\nb"]


def test_sample_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    nested = spark.createDataFrame([([["a", "b"], ["c"]],)], "samples array<array<string>>")
    flat = spark.createDataFrame([(["d"],)], "samples array<string>")
    texts.append_sample_log(nested, path)
    texts.append_sample_log(flat, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["a\tb\tc", "d"]


@pytest.mark.parametrize("options", [{"trim": 16}, {"block": 16}, {}, {"trim": 16, "shuffle": True}])
def test_folder_to_dataset(spark, tmp_path, texts, options):
    for f in range(2):
        lines = [json.dumps({"text": f"<s>{t}</s>"}) for t in texts[20 + f:60:2]]
        (tmp_path / f"in{f}.jsonl").write_text("\n".join(lines) + "\n")
    root = encode_folder(spark, str(tmp_path / "in*.jsonl"), bpe.byte_tokenizer(spark), str(tmp_path))
    out = make_dataset(spark, root, str(tmp_path / "set"), dev_ratio=0.25, name="_x", **options)
    rows = tokens.read_token_lists(spark, out).orderBy("split", "doc_id").collect()
    for name in ("dev_x", "train_x"):  # the parts of a split are one file, numbered from 0
        own = [(r.file, r.doc_id) for r in rows if r.split == name]
        assert own == [(f"split={name}", i) for i in range(len(own))]
    dev = [r.ids for r in rows if r.split == "dev_x"]
    train = [r.ids for r in rows if r.split == "train_x"]
    assert len(dev) == round(0.25 * len(rows)) and len(dev) + len(train) == len(rows)
    if "block" in options:
        flat = [r.ids for r in tokens.read_token_lists(spark, root).orderBy("file", "doc_id").collect()]
        assert [x for ids in dev + train for x in ids] == [x for ids in flat for x in ids]


def test_tokenizer_from_sentence_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"sents": ["low lower lowest"] * 3}))
    (tmp_path / "b.json").write_text("{")
    for kind in ("BPE", "WordPiece"):
        tok, rejects = train_tokenizer(spark, str(tmp_path / "*.json"), kind, size=275)
        assert [r.file for r in rejects.collect()] == ["b.json"]
        assert tok.merges.count() > 0


def test_streaming_encode_takes_new_files_once(spark, tmp_path):
    source, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    source.mkdir()
    tok = bpe.byte_tokenizer(spark)
    for k in range(2):
        (source / f"part{k}.jsonl").write_text(json.dumps({"text": "a\n\nb" + "!" * k}) + "\n")
        query = encode_new_files(spark, str(source), tok, out, progress)
        assert query.awaitTermination(60)
    rows = tokens.read_token_lists(spark, out + "/encoded").collect()
    assert {r.file: len(r.ids) for r in rows} == {"part0.jsonl": 2, "part1.jsonl": 3}


def test_small_sentence_files_are_parsed_whole(spark, tmp_path, monkeypatch):
    """Small files need no shuffle and no table on the way; the way of the large ones gives the same rows."""
    bodies = {
        "plain": json.dumps({"sents": ["a", 'b"', "c\\", "é\U0001f600", ""], "n": [1, {"sents": ["x"]}]}), "empty": '{"sents": []}',
        "half": r'{"sents": ["\ud83d", "😀", "a\udc80b"]}', "again": '{"sents": ["a"], "sents": ["b", "c"]}',
        "name": r'{"sents": ["a\/b"]}', "number": '{"sents": ["a", 1]}', "cut": '{"sents": ["a"', "list": '["sents", ["a"]]',
        "other": '{"lines": ["a"]}', "after": '{"sents": ["a"], "sents": 5}', "deep": "[" * 100_000, "trailing": '{"sents": ["a"]} x'}
    for name, body in bodies.items():
        folder = tmp_path / f"file={name}"
        folder.mkdir()
        (folder / "part-0.txt").write_text(body, encoding="utf-8")
    (tmp_path / "file=broken").mkdir()
    (tmp_path / "file=broken" / "part-0.txt").write_bytes(b'{"sents": ["a\xff", "\xe2\x82 b"]}')
    (tmp_path / "file=none").mkdir()
    (tmp_path / "file=none" / "part-0.txt").write_bytes(b"")

    def found(bound):
        monkeypatch.setattr(sentence_files, "WHOLE_BYTES", bound)
        sents, rejects, report = texts.read_tolerant(spark, str(tmp_path))
        return sents, sorted(map(tuple, sents.collect())), sorted(r.file for r in rejects.collect()), tuple(report.first())

    whole, *small = found(sentence_files.WHOLE_BYTES)
    assert "Exchange" not in whole._jdf.queryExecution().toString()
    assert [sent for file, _, sent in small[0] if file in ("half", "again", "name", "broken")] == [
        "b", "c", "a�", "� b", "?", "\U0001f600", "a?b", "a/b"]
    assert small[1] == ["after", "cut", "deep", "list", "number", "other", "trailing"]
    assert small[2] == (13, 13)
    assert tuple(small) == found(0)[1:] == found(40)[1:]


def test_large_sentence_files_are_shared_between_tasks(spark, tmp_path, split_sizes, monkeypatch):
    monkeypatch.setattr(sentence_files, "WHOLE_BYTES", 0)
    test_sentence_files_are_shared_between_tasks(spark, tmp_path, split_sizes)
