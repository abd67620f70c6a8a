import corpus_pipeline
import public_tokenizers
from sentencepiece import SentencePieceProcessor

from roadlens.llm import decontaminate, pii, quality, simhash_dedup

SF = "/root/testdata/sf0.001"


def test_each_stage_on_its_own_input(spark, tmp_path):
    docs, columns = spark.read.parquet(f"{SF}/documents.parquet"), None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = columns or docs.columns
        out = stage(spark, docs, SF)
        assert out.columns[: len(columns)] == columns and (k == 4 or out.columns == columns)
        out.write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        had, has = ({r["doc_id"]: r for r in df.collect()} for df in (before, docs))
        assert set(has) <= set(had) and docs.count() == len(has)
        if k == 0:
            rejected = {r["doc_id"] for r in quality.scores(before, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r["predicted"] == 0}
            assert set(had) - set(has) == rejected
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert all(labels.get(i) != 1 for i in rejected)
        elif k == 1:
            prints = {i: simhash_dedup.fingerprint(r["text"]) for i, r in had.items()}
            linked = lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3
            ids = sorted(has)
            assert not any(linked(a, b) for i, a in enumerate(ids) for b in ids[:i])
            gone = set(had) - set(has)
            assert gone and all(any(linked(g, x) for x in had if x != g) for g in gone)
        elif k == 2:
            leaks = {r["doc_id"] for r in decontaminate.contaminated(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert set(had) - set(has) == leaks
        elif k == 3:
            assert set(has) == set(had)
            scanned = pii.scan(docs).filter("n_email + n_ip + n_card > 0").count()
            assert scanned == 0 and all(r["n_chars"] == len(r["text"]) for r in has.values())
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert all(list(r["piece_ids"]) == library.encode(r["text"]) and r["exact"] for r in has.values())


def test_stages_of_odd_documents(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a b c d", None, "s", 7), (3, "word " * 40_000, "en", "s", 200_000)]
    docs = spark.createDataFrame(rows, columns)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        assert stage(spark, docs, SF).count() <= len(rows)


CLASHES = "spans id fp x y c n least component_id calibrate score held_out key text_ p begin item_id piece_id".split()


def test_stages_keep_extra_columns_and_odd_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    own = [(i, texts[i]) for i in list(labels)[:40]]
    odd = [(900_001, None), (900_002, ""), (900_002, ""), (None, "a b c d"), (900_003, "word " * 40_000 + "+1 (555) 010-9999"), (900_004, f"see {item} there"), (900_005, own[0][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *[f"{k}{i}" for k in CLASHES]) for i, t in own + odd], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES))
    before = {}
    for r in docs.collect():
        before.setdefault(r["doc_id"], []).append(r)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns
        rows, empty = out.collect(), stage(spark, docs.limit(0), SF)
        assert empty.collect() == [] and empty.columns == out.columns
        for r in rows:
            same = [c for c in docs.columns if k != 3 or c not in ("text", "n_chars")]
            assert any(all(r[c] == b[c] for c in same) for b in before[r["doc_id"]])
        ids = [r["doc_id"] for r in rows]
        if k == 0:  # equal texts stay or go together, null and empty ones are one
            assert ids.count(900_002) in (0, 2) and (900_001 in ids) == (900_002 in ids) and (own[0][0] in ids) == (900_005 in ids)
        elif k == 1:  # the group of null and empty texts is named by its least id, a text that repeats by its own
            assert 900_001 in ids and 900_002 not in ids and 900_005 not in ids and None in ids and len(ids) == len(set(ids))
        elif k == 2:
            assert 900_004 not in ids and ids.count(900_002) == 2 and {900_001, 900_003, None} <= set(ids)
        elif k == 3:
            long = next(r for r in rows if r["doc_id"] == 900_003)
            assert len(rows) == len(own) + len(odd) and long["text"].endswith("<PHONE>") and long["n_chars"] == len(long["text"])
            assert all(r["text"] is None and r["n_chars"] is None for r in rows if r["doc_id"] == 900_001)
        else:
            assert len(rows) == len(own) + len(odd) and all(r["exact"] for r in rows)
