"""Token ids in compressed binary files with a shared dictionary.

A table of token files is a Parquet folder in doc_id order. A row is a block of documents: one zstandard frame for each
document, compressed on its own with a shared dictionary, back to back in `frames`; `bounds` is the offset index of the
frames, `counts` the number of ids of each document, `dictionary` the SHA-256 of the dictionary, which lies beside the
blocks. So a single short document is read by finding its block by the range of ids (Parquet's own statistics), and
decompressing one frame. Ids are little-endian, two bytes each if the vocabulary allows, four otherwise.
"""

from __future__ import annotations

import hashlib
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path

BLOCK_TOKENS = 1 << 18
BLOCK_DOCS = 2_000
DICTIONARY_BYTES = 64 << 10
#: The dictionary is trained on at most so many documents, the first by a hash of their ids, of at most so many ids each.
SAMPLE_DOCS = 2_000
SAMPLE_IDS = 4_096
LEVEL = 2
#: Characters whose chunks are told apart together, characters that the library takes in one go, pre-tokens of a long string.
STRETCH, BATCH, GROUP = 1 << 23, 1 << 17, 128
#: Documents of a range of ids, and ranges at most: a range is written by one task.
RANGE_DOCS, MOST_RANGES = 50_000, 100_000
BLOCK_SCHEMA = "part int, block int, first_id long, last_id long, doc_ids array<long>, counts array<long>, bounds array<long>, frames binary, dictionary string, width int"


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable Latin-1 as itself, the others by the characters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return {b: chr(b if b in shown else next(hidden)) for b in range(256)}


def _of_class(codes: Iterable[int], kinds: str) -> str:
    """The characters of some general categories, as the inside of a bracket of a regular expression."""
    return re.escape("".join(chr(c) for c in codes if unicodedata.category(chr(c))[0] in kinds))


#: A space that no visible character follows, and one that one follows.
LOOSE, FAST = re.compile(r" (?![^\s\x00-\x20\x7f-\xa0])"), re.compile(r" (?=[^\s\x00-\x20\x7f-\xa0])")
#: Letters and marks in blocks that every version of Unicode agrees on.
LETTERS, MARKS = _of_class(range(0x500), "L"), _of_class([*range(0x100), *range(0x2010, 0x2028), *range(0x2030, 0x205F)], "PS")
#: A chunk whose pre-tokens are told without the tokenizer, and those of its pre-tokens that are no words.
PLAIN, NO_WORD = rf"\A ?(?:[{LETTERS}0-9{MARKS}]+\n?)*\z", rf"'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[{MARKS}]+|\n"
#: Bytes that the vocabulary writes otherwise than Latin-1 does.
HIDDEN = {chr(b): x for b, x in _byte_letters().items() if chr(b) != x}
#: A byte that no UTF-8 text has, as byte-level vocabularies write it: it ends a pre-token.
WORD_END = "\xff"


class Encoder:
    """Ids of texts by a file of the tokenizers library, asked once in a stretch of texts for each different chunk.

    A text is cut before each single space that a visible character follows: no token of a byte-level pre-tokenizer with
    the usual pattern lies across such a place, so the ids of the chunks joined are the ids of the text. Which files this
    holds for is asked of the file; any other is applied to whole texts. Chunks of words, digits and marks on single lines
    have pre-tokens that are told apart here; the different ones go to the file's model in long strings, with a byte between
    them that it has no merges for. All others go through the whole tokenizer.
    """

    def __init__(self, path: str, kind: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), kind
        pre, model, vocabulary = self.tokenizer.pre_tokenizer, self.tokenizer.model, self.tokenizer.get_vocab()
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.by_chunk = type(pre).__name__ == "ByteLevel" and not pre.add_prefix_space and pre.use_regex and self.tokenizer.normalizer is None
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.bare, self.word_end = Tokenizer(model), vocabulary.get(WORD_END)
        merges_only = type(model).__name__ == "BPE" and not (model.dropout or model.ignore_merges or model.continuing_subword_prefix or model.end_of_word_suffix)
        self.by_word = self.by_chunk and merges_only and [x for x in vocabulary if WORD_END in x] == [WORD_END]
        probes = ["a b word", " \u00e9tait, end.\nNext what?", "\u044f\u0437\u044b\u043a! it's 'so' 12 \u201cno\u201d"]
        self.by_word = self.by_word and all(map(np.array_equal, self._ids(probes), self._stretch(probes)))

    def _ids(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        for own in _stretches(texts, BATCH):
            yield from [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(own, add_special_tokens=False)]

    def _of_words(self, words: pa.Array) -> pa.LargeListArray:
        """The ids of different pre-tokens, taken through the model in strings of GROUP of them."""
        groups = pc.binary_join(pa.ListArray.from_arrays([*range(0, len(words), GROUP), len(words)], words), pa.scalar("\r", words.type)).to_pylist()
        found = [np.zeros(0, "<u4")]
        for k in range(0, len(groups), 64):
            shown = "\r\0".join([*groups[k : k + 64], ""]).encode().decode("latin-1").replace("\r", WORD_END)
            for byte, letter in HIDDEN.items():
                shown = shown.replace(byte, letter)
            said = self.bare.encode_batch_fast(shown.split(HIDDEN["\0"])[:-1], add_special_tokens=False)
            found += [np.frombuffer(array("I", e.ids), "<u4") for e in said]
        ids = np.concatenate(found)
        real = ids != self.word_end
        return pa.LargeListArray.from_arrays(np.r_[0, np.cumsum(real)[~real]], ids[real].astype(self.kind))

    def _of_plain(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain chunks, one after another, and where each chunk's begin and the last one's end."""
        cut = pc.split_pattern(pc.replace_substring_regex(chunks, NO_WORD, "\v\\0\v"), "\v")
        words = cut.flatten().dictionary_encode()
        found = self._of_words(words.dictionary).take(words.indices)
        return found.values.to_numpy(), found.offsets.to_numpy()[np.r_[0, np.cumsum(pc.list_value_length(cut).to_numpy())]]

    def _learn(self, chunks: pa.Array) -> tuple[pa.LargeListArray, np.ndarray]:
        """The ids of different chunks, plain ones first, and the place of each chunk there."""
        spaced = pc.replace_substring_regex(pc.binary_join_element_wise(pa.scalar("", chunks.type), chunks, pa.scalar(" ", chunks.type)), r"\A \t", "")
        plain = pc.match_substring_regex(spaced, PLAIN).to_numpy(zero_copy_only=False) if self.by_word else np.zeros(len(chunks), bool)
        ids, bounds = self._of_plain(spaced.filter(plain)) if plain.any() else (np.zeros(0, self.kind), np.zeros(1, int))
        odd = list(self._ids(spaced.filter(~plain).to_pylist()))
        bounds = np.r_[bounds, bounds[-1] + np.cumsum([len(x) for x in odd], dtype=int)]
        return pa.LargeListArray.from_arrays(bounds, np.concatenate([ids, *odd])), np.where(plain, np.cumsum(plain), plain.sum() + np.cumsum(~plain)) - 1

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for own in _stretches(texts, STRETCH):
            yield from self._stretch(own)

    def _stretch(self, texts: list[str]) -> list[np.ndarray]:
        kinds = ["whole" if not self.by_chunk or any(x in t for x in self.special) else "loose" if LOOSE.search(t) else "tidy" for t in texts]
        whole, loose, tidy = ([k for k, kind in enumerate(kinds) if kind == x] for x in ("whole", "loose", "tidy"))
        out = dict(zip(whole, self._ids(texts[k] for k in whole)))
        # a tab, which begins no other chunk, tells the first, which has no space before it
        cut = pc.split_pattern(pa.array(["\t" + texts[k] for k in tidy], pa.large_string()), " ")
        cut_loose = [FAST.split("\t" + texts[k]) for k in loose]
        chunks = pa.concat_arrays([cut.flatten(), pa.array([x for c in cut_loose for x in c], pa.large_string())]).dictionary_encode()
        pool, places = self._learn(chunks.dictionary)
        found = pool.take(pa.array(places[chunks.indices.to_numpy()]))
        starts = np.cumsum([0, *pc.list_value_length(cut).to_pylist(), *map(len, cut_loose)])
        bounds, ids = found.offsets.to_numpy()[starts].tolist(), found.values.to_numpy()
        out.update((k, ids[lo:hi]) for k, lo, hi in zip([*tidy, *loose], bounds, bounds[1:]))
        return [out[k] for k in range(len(texts))]


def _stretches(texts: Iterable[str], most: int) -> Iterator[list[str]]:
    """Texts in lists of about `most` characters: a list ends with the text that brings it there."""
    own, size = [], 0
    for text in texts:
        own.append(text)
        size += len(text)
        if size >= most or len(own) >= most:
            yield own
            own, size = [], 0
    if own:
        yield own


@lru_cache(maxsize=4)
def encoder(path: str, kind: str) -> Encoder:
    """One to a Python worker."""
    return Encoder(path, kind)


def _width(path: str) -> int:
    return 2 if encoder(path, "<u4").vocabulary <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """A dictionary trained on a bounded sample of serialised id arrays; empty if there is too little to train on."""
    kind = f"<u{_width(tokenizer)}"
    draw = F.xxhash64(id_col)
    # ids alone tell where the sample ends; the limit below only matters where ids repeat
    last = docs.select(draw.alias("o")).orderBy("o").limit(SAMPLE_DOCS).agg(F.max("o")).first()[0]
    sample = docs.filter(draw <= F.lit(last)).select(F.col(text_col).alias("t"))

    def serialised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = encoder(tokenizer, kind)
        for b in batches:
            yield pd.DataFrame({"ids": [x[:SAMPLE_IDS].tobytes() for x in of([t or "" for t in b["t"]])]})

    arrays = [r["ids"] for r in sample.mapInPandas(serialised, "ids binary").limit(SAMPLE_DOCS).collect()] if last is not None else []
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> None:
    """Writes the token files of docs: in ascending id order (nulls first), each text's ids followed by end_id.

    Null texts count as empty. Rows with equal ids come one after another in no given order. An empty table makes files without blocks.
    """
    spark, width = docs.sparkSession, _width(tokenizer)
    dictionary = train_dictionary(docs, tokenizer, id_col, text_col)
    name, kind, end = hashlib.sha256(dictionary).hexdigest(), f"<u{width}", [] if end_id is None else [end_id]
    spark.createDataFrame([(name, bytearray(dictionary))], "dictionary string, bytes binary").write.mode("overwrite").parquet(f"{path}/dictionary")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, tail = encoder(tokenizer, kind), np.array(end, kind).tobytes()
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        number, ids, counts, frames, tokens = 0, [], [], [], 0

        def block() -> pd.DataFrame:
            real = [i for i in ids if i is not None]
            row = {"part": 0, "block": number, "first_id": min(real, default=None), "last_id": max(real, default=None), "doc_ids": ids, "counts": counts, "bounds": np.r_[0, np.cumsum([len(f) for f in frames])].tolist(), "frames": b"".join(frames), "dictionary": name, "width": width}
            return pd.DataFrame([row])

        for b in batches:
            for i, found, part in zip(b["i"], of([t or "" for t in b["t"]]), b["p"]):
                raw = found.tobytes() + tail
                ids.append(None if pd.isna(i) else int(i))
                counts.append(len(raw) // width)
                frames.append(squeeze.compress(raw))
                tokens += counts[-1]
                if tokens >= BLOCK_TOKENS or len(ids) >= BLOCK_DOCS:
                    yield block().assign(part=part)
                    number, ids, counts, frames, tokens, last = number + 1, [], [], [], 0, part
                last = part
        if ids:
            yield block().assign(part=last)

    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    # ranges grow in number with the table, not in size
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(rows.count() // RANGE_DOCS, MOST_RANGES))
    # the number of a row as read tells rows of one id, or of none, apart, so that they need not lie in one range
    numbered = rows.withColumn("k", F.monotonically_increasing_id())
    ordered = numbered.repartitionByRange(n, "i", "k").sortWithinPartitions("i", "k").select("i", "t", F.spark_partition_id().alias("p"))
    ordered.mapInPandas(blocks, BLOCK_SCHEMA).write.mode("overwrite").parquet(f"{path}/blocks")


def _opened(path: str, spark: SparkSession) -> tuple[DataFrame, Callable]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    name, raw = row["dictionary"], bytes(row["bytes"])
    if hashlib.sha256(raw).hexdigest() != name:
        raise ValueError(f"the dictionary in {path} is damaged")

    def opener(wanted: str):
        if wanted != name:
            raise ValueError("a block was made with another dictionary")
        return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)

    return spark.read.parquet(f"{path}/blocks"), opener


def read(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids): one row per document, from the files alone, in no order.

    start is the number of ids of all documents before it in file order; only one row per block is needed to tell it.
    """
    stored, opener = _opened(path, spark)

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                unpack, at, out = opener(r.dictionary), 0, []
                view = memoryview(r.frames)
                for i, n, lo, hi in zip(r.doc_ids, r.counts, r.bounds, r.bounds[1:]):
                    got = np.frombuffer(unpack.decompress(view[lo:hi]), f"<u{r.width}").astype("<u4")
                    if len(got) != n:
                        raise ValueError("a frame does not hold the ids that its block counts")
                    out.append((i, r.part, r.block, at, n, zlib.crc32(got.tobytes())) + ((got.tolist(),) if ids else ()))
                    at += n
                frame = pd.DataFrame(out, columns=["doc_id", "part", "block", "at", "n_tokens", "ids_crc32", *["ids"] * ids])
                frame["doc_id"] = frame["doc_id"].astype("Int64")
                yield frame

    docs = stored.mapInPandas(documents, "doc_id long, part int, block int, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)
    sums = stored.select("part", "block", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    in_part = sums.select("part", "block", (F.sum("n").over(Window.partitionBy("part").orderBy("block")) - F.col("n")).alias("before"))
    # one row per part: as many as the writer had partitions
    parts = sums.groupBy("part").agg(F.sum("n").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    starts = in_part.join(F.broadcast(parts), "part").select("part", "block", (F.col("before") + F.col("base")).alias("base"))
    return docs.join(starts, ["part", "block"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids)


def document_ids(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (of each row with that id): reads the blocks whose range holds it and one frame of each."""
    stored, opener = _opened(path, spark)
    out = []
    for r in stored.filter((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).filter(F.array_contains("doc_ids", doc_id)).toLocalIterator():
        for k in [k for k, i in enumerate(r["doc_ids"]) if i == doc_id]:
            out.append(np.frombuffer(opener(r["dictionary"]).decompress(bytes(r["frames"])[r["bounds"][k] : r["bounds"][k + 1]]), f"<u{r['width']}").tolist())
    return out


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the token files of docs into the shared folder and reads them back."""
    path = new_path(docs.sparkSession, "token-files")
    write(docs, path, tokenizer)
    return read(docs.sparkSession, path)
