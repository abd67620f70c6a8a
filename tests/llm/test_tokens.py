import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from roadlens.llm import queries, sentencepiece_codec, token_files
from roadlens.llm.common import new_path

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = " \n\t\r ab'sé1.,<|>the  ​\x1c\x85　中😀_"


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(50))) for _ in range(n)]


ODD = ["", " ", "  a", "a\n\nb", "a \n b", "<|endoftext|>", "a <|endoftext|> b", " 's 're", "x" * 50_000, "the and of " * 20_000, "中文" * 5_000, "é", "᠎ a", "don't", "foo.\nBar baz,"]


def test_byte_level_ids_are_the_librarys():
    own, library = token_files.encoder(BYTES, "<u2"), Tokenizer.from_file(BYTES)
    texts = ODD + random_texts(4000)
    assert own.by_word and own.by_chunk
    for text, got in zip(texts, own(texts), strict=True):
        assert got.tolist() == library.encode(text, add_special_tokens=False).ids, text[:50]


def test_chunks_of_marks_digits_and_contractions_are_the_librarys():
    own, library = token_files.encoder(BYTES, "<u2"), Tokenizer.from_file(BYTES)
    rng = random.Random(7)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for letters in (" ab'stmdrevl", "aé'’“”—…×²½ª\xad\xa0 \n1", "ÿþ яжα' .1\u0300", "\t\v\0\r \nab", " ab1.\n") for _ in range(2000)]
    for text, got in zip(texts, own(texts), strict=True):
        assert got.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_words_that_do_not_repeat_take_half_the_librarys_time():
    own, library = token_files.encoder(BYTES, "<u2"), Tokenizer.from_file(BYTES)
    rng = random.Random(8)
    syllables = ["er", "tion", "bre", "an", "lich", "ou", "sta", "thé", "ing", "po", "kä", "ne"]
    texts = [" ".join("".join(rng.choices(syllables, k=rng.randrange(2, 6))) + rng.choice(["", "", ".", ",###"]) for _ in range(400)) for _ in range(500)]
    times = []
    for encode in (lambda: [x.tolist() for x in own(texts)], lambda: [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]):
        begun = time.process_time()
        ids = encode()
        times.append(time.process_time() - begun)
    assert ids == [x.tolist() for x in own(texts)]
    assert times[0] < times[1] / 2, times


def expected(rows):
    library, at, out = Tokenizer.from_file(BYTES), 0, {}
    for i, text in sorted(rows):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    return out


def test_token_files_of_the_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.QUERIES["op9_token_binary"](spark, SF).collect()}
    assert got == expected(rows)


def test_token_files_of_odd_rows_and_one_document(spark):
    rows = [(10 * i, t) for i, t in enumerate([None, *ODD])]
    df = spark.createDataFrame([(*r, "b", 1) for r in rows], "doc_id long, text string, block string, part int").repartition(5)
    path = new_path(spark, "tokens")
    token_files.write(df, path, BYTES, partitions=4)
    got = {r["doc_id"]: r for r in token_files.read(spark, path, ids=True).collect()}
    assert {i: (r["start"], r["n_tokens"], r["ids_crc32"]) for i, r in got.items()} == expected(rows)
    assert token_files.document_ids(spark, path, 130) == [list(got[130]["ids"])]
    assert token_files.document_ids(spark, path, 131) == []


def test_token_files_of_repeated_nameless_and_no_rows(spark):
    schema = "doc_id long, text string"
    out = token_files.round_trip(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], schema), BYTES).collect()
    assert sorted((str(r["doc_id"]), r["start"], r["n_tokens"]) for r in out) == [("1", 2, 3), ("1", 5, 3), ("None", 0, 2)]
    assert token_files.round_trip(spark.createDataFrame([], schema), BYTES).collect() == []


def test_rows_of_one_id_are_dealt_over_ranges(spark):
    df = spark.createDataFrame([(7 if k % 3 else None if k % 2 else k, f"text {k}") for k in range(900)], "doc_id long, text string").repartition(6)
    path = new_path(spark, "tokens")
    token_files.write(df, path, BYTES, partitions=8)
    per_part = [r["n"] for r in spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n")).collect()]
    assert max(per_part) < 300 and sum(per_part) == 900
    out = token_files.read(spark, path, ids=True).orderBy("start").collect()
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in out]
    assert ids == sorted(ids) and [r["start"] for r in out] == np.cumsum([0, *(r["n_tokens"] for r in out)])[:-1].tolist()
    assert len(token_files.document_ids(spark, path, 7)) == 600


def test_a_damaged_dictionary_is_noticed(spark):
    path = new_path(spark, "tokens")
    token_files.write(spark.read.parquet(f"{SMALL}/documents.parquet"), path, BYTES, partitions=2)
    spark.createDataFrame([("0" * 64, bytearray(b"x"))], "dictionary string, bytes binary").write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(ValueError):
        token_files.read(spark, path)


def test_pieces_are_the_librarys():
    own, library = sentencepiece_codec.codec(PIECES), SentencePieceProcessor(model_file=PIECES)
    for text in ODD + ["▁", "a▁b"] + random_texts(4000, 5):
        assert own.encode(text).tolist() == library.encode(text), text[:50]
        if "▁" not in text:
            assert own.decode(own.encode(text)) == text


def test_paths_commit_where_they_meet(spark):
    own, library = sentencepiece_codec.codec(PIECES), SentencePieceProcessor(model_file=PIECES)
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    before = own.commits
    values, counts = own.encode_all(texts)
    assert own.commits - before > 100_000
    bounds = np.r_[0, np.cumsum(counts)]
    assert all(library.encode(t) == values[i:j].tolist() for t, i, j in zip(texts, bounds, bounds[1:]))


@pytest.mark.parametrize("size", [40, 64, 1000])
def test_texts_longer_than_a_slice_are_carried_on(monkeypatch, size):
    monkeypatch.setattr(sentencepiece_codec, "SLICE", size)
    own, library = sentencepiece_codec.codec(PIECES), SentencePieceProcessor(model_file=PIECES)
    for text in ["theandtionofing" * 40, "a" * 700, "=" * 300 + "-" * 300, "ab cd the of" * 60, "中文" * 200, *random_texts(60, 8), "".join(random_texts(40, 9))]:
        assert own.encode(text).tolist() == library.encode(text), text[:50]


def test_a_text_of_ten_million_characters():
    own, library = sentencepiece_codec.codec(PIECES), SentencePieceProcessor(model_file=PIECES)
    text = "".join(random_texts(20_000, 2)) * 21
    assert len(text) > 10_000_000 and own.encode(text).tolist() == library.encode(text)


def test_pairs_are_told_as_merging_tells_them():
    own, rng = sentencepiece_codec.codec(PIECES), random.Random(6)
    short = [i for x, i in own.ids.items() if len(x) < 4]
    pairs = np.array([(rng.choice(short if k % 2 else list(own.ids.values())), rng.choice(short)) for k in range(3000)])
    for (a, b), fits in zip(pairs.tolist(), own._side_by_side(*pairs.T), strict=True):
        want = [own.pieces[a], own.pieces[b]]
        assert fits == (own.merge("".join(want)) == want), want


def test_pieces_of_the_whole_table(spark):
    library = SentencePieceProcessor(model_file=PIECES)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    out = queries.QUERIES["op2_sentencepiece"](spark, SMALL).collect()
    assert len(out) == len(texts) and all(r["exact"] for r in out)
    assert {r["doc_id"]: list(r["piece_ids"]) for r in out} == {k: library.encode(t) for k, t in texts.items()}


def test_pieces_of_odd_rows(spark):
    schema = "doc_id long, text string, piece_ids string, exact int, __x int"
    rows = [(1, None, "a", 0, 1), (2, "", "a", 0, 1), (2, "", "a", 0, 1), (3, "a▁b", "a", 0, 1), (None, "ab c", "a", 0, 1)]
    out = sentencepiece_codec.encoded(spark.createDataFrame(rows, schema), PIECES)
    back = sentencepiece_codec.decoded(out.drop("text"), PIECES).collect()
    assert sorted((str(r["doc_id"]), r["n_pieces"], r["exact"], r["decoded"], r["__x"]) for r in back) == [
        ("1", 0, True, None, 1), ("2", 0, True, "", 1), ("2", 0, True, "", 1), ("3", back_n(out, 3), False, "a b", 1), ("None", back_n(out, None), True, "ab c", 1),
    ]
    assert sentencepiece_codec.encoded(spark.createDataFrame([], schema), PIECES).collect() == []


def back_n(out, doc_id):
    return out.filter(F.col("doc_id").eqNullSafe(F.lit(doc_id))).first()["n_pieces"]
