from roadlens.llm import common

SF = "/root/testdata/sf0.01"


def exchanges(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Repartition")


def test_only_small_tables_in_few_files_are_dealt_out(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert exchanges(common.spread(docs)) == exchanges(common.spread(docs.select("text").filter("doc_id > 5"))) == 1
    many = str(tmp_path / "many")
    docs.repartition(40).write.parquet(many)
    assert exchanges(common.spread(spark.read.parquet(many))) == 0
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:  # beside such splits the table is a large one: its file names are not asked for
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        large = spark.read.parquet(f"{SF}/documents.parquet")
        large.inputFiles = None
        assert common.spread(large) is large
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert exchanges(common.spread(spark.createDataFrame([(1,)], "a int"))) == 0
