import hashlib
import random
import re
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import chat_format, pii, queries, secret_scan

SF = "/root/testdata/sf0.01"
CLASH = ", spans string, all string, key long, rules string, kind string, start int, text_ string"


def rows_with_clashes(spark, texts):
    data = [(i, t, "x", "y", 1, "z", "k", 2, "w") for i, t in texts]
    return spark.createDataFrame(data, "doc_id long, text string" + CLASH)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_private(text):
    """The base spans by the standard library: (start, rank, end, kind)."""
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


def base_secrets(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m.group()) >= 20:
            out.append((m.start(), 1, m.end(), "access"))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m.group()) >= 24:
            out.append((m.start(), 2, m.end(), "hex"))
    return sorted(out)


def check(out, text, base, kinds):
    want = base(text)
    assert [out[f"n_{k}"] for k in kinds] == [sum(w[3] == k for w in want) for k in kinds]
    listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in want)
    assert out["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
    assert set(listed.split(",")) - {""} <= set(out["spans"].split(","))


PRIVATE = [
    "", None, "no data", "a@b.c_d@e.f and x..y@z-1.com.", "@a.b a@b", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004", "4111 1111 1111 1111", "4111-1111-1111-1111 5", "4111  1111 1111 1111",
    "37 8282 2463 10005 and 12345678901234567890", "+1 (555) 010-9999 and +49.30.1234567-", "+1 5", "é😀 mail: émile@x.fr 10.0.0.1", "DE89 3704 0044 0532 0130 00, GB82WEST12345698765432.", "0" * 15 + " " + "0" * 16, "1 " * 3000 + "a@b.co", "x" * 200_000 + "@y.de", "+" * 5000, "1.1." * 4000,
]


def test_private_data_of_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(PRIVATE)] + [(0, ""), (None, "a@b.co")]
    got = pii.scan(rows_with_clashes(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        check(r, PRIVATE[r["doc_id"]] if r["doc_id"] is not None else "a@b.co", base_private, ["email", "ip", "card", "phone"])
    iban = next(r["spans"] for r in got if r["doc_id"] == PRIVATE.index("DE89 3704 0044 0532 0130 00, GB82WEST12345698765432."))
    assert [x for x in iban.split(",") if x.startswith("iban")] == ["iban:0:27", "iban:29:51"]
    assert pii.scan(rows_with_clashes(spark, [])).collect() == []


def test_private_data_of_the_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.QUERIES["op7_pii"](spark, SF).collect():
        check(r, texts[r["doc_id"]], base_private, ["email", "ip", "card", "phone"])


ACCOUNTS = [
    ("GB82WEST12345698765432 Please pay", "0:22"), ("DE89370400440532013000 2024", "0:22"), ("DE89 3704 0044 0532 0130 00 BIC COBADEFF", "0:27"), ("é😀 DE89 3704 0044 0532 0130 00 Bank", "3:30"),
    ("DE89370400440532013000 GB82WEST12345698765432 A", "0:22 23:45"), ("AB12 CDEF GHIJ KLMN GB82 WEST 1234 5698 7654 32 OK", "20:47"), ("NO9386011117947 X", "0:15"), ("MT84 MALT 0110 0001 2345 MTLC AST0 01S 5", "0:38"),
    ("DE89370400440532013000EUR", ""), ("DE89370400440532013001 A", ""), ("xDE89370400440532013000", ""), ("DE89370400440532013000x", ""), ("DE89370400440532013000  9", "0:22"),
]


def account(country, rest):
    value = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{country}{98 - value % 97:02d}{rest}"


def test_account_numbers_before_capitals_and_digits(spark):
    rng = random.Random(4)
    rows, want = [t for t, _ in ACCOUNTS], [w.split() for _, w in ACCOUNTS]
    # every registered length and, for a country that has none, every length: in one piece and in groups of four
    for n, c in [(n, c) for n, cs in pii.REGISTERED.items() for c in cs.split()] + [(n, "ZZ") for n in range(15, 35)]:
        x = account(c, "".join(rng.choice("ABCXYZ0123456789") for _ in range(n - 4)))
        for x in (x, " ".join(x[i : i + 4] for i in range(0, n, 4))):
            rows += [f"to {x} Now", f"to {x} 7", f"to {x}."]
            want += [[f"3:{3 + len(x)}"]] * 3
    got = {r["doc_id"]: r["spans"] for r in pii.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    for i, (t, w) in enumerate(zip(rows, want)):
        spans = [s.removeprefix("iban:") for s in got[i].split(",") if s.startswith("iban:")]
        assert spans == w or ("ZZ" in t and spans[0].split(":")[0] == "3" and int(spans[0].split(":")[1]) >= int(w[0].split(":")[1])), t
    masked = pii.masked(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(ACCOUNTS)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["text"] for r in masked][:3] == ["<IBAN> Please pay", "<IBAN> 2024", "<IBAN> BIC COBADEFF"]


CONTEXTS = [
    ("her ssn is 078-05-1120 .", "ssn:11:22", "65"), ("row 078-05-1120 of", "", ""), ("SSN of the order 078-05-1120", "", ""), ("Social Security: 000-12-3456, 666-12-3456, 900-12-3456, 123-00-4567, 123-45-0000", "", ""),
    ("ssn 078-05-1120-1 and 1078-05-1120", "", ""), ("078-05-1120" + " " * 12 + "(ssn)", "ssn:0:11", "65"), ("078-05-1120" + " " * 22 + "(ssn)", "", ""), ("ssn" + " " * 50 + "078-05-1120", "", ""),
    ("ip 10.0.0.1", "ip:3:11", "85"), ("see 10.0.0.1", "ip:4:12", "60"), ("Version 10.0.0.1", "ip:8:16", "35"), ("server version 10.0.0.1", "ip:15:23", "60"), ("inversion 10.0.0.1", "ip:10:18", "60"),
    ("order 4111 1111 1111 1111", "card:6:25", "55"), ("IBAN GB82WEST12345698765432", "iban:5:27", "115"), ("example a@b.co", "email:8:14", "65"),
]


def test_words_nearby_move_scores_over_the_threshold(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(CONTEXTS)], "doc_id long, text string")
    got = {r["doc_id"]: (r["spans"], r["scores"]) for r in pii.scan(df).collect()}
    for i, (text, spans, scores) in enumerate(CONTEXTS):
        assert got[i] == (spans, scores), text
    texts = {r["doc_id"]: r["text"] for r in pii.masked(df).collect()}
    assert texts[0] == "her ssn is <SSN> ." and texts[1] == CONTEXTS[1][0] and texts[2] == CONTEXTS[2][0]
    # a base kind below the threshold is found but not masked
    assert texts[8] == "ip <IP>" and texts[10] == "Version 10.0.0.1" and texts[11] == "server version <IP>"


def test_private_data_by_sql_on_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate([*PRIVATE, *(t for t, _ in ACCOUNTS), *(t for t, _, _ in CONTEXTS)]) if len(t or "") < 10_000]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(f"SELECT doc_id, spans, scores, base_sha256 FROM ({queries.ORACLES['op7_pii']})").fetchall()
    got = [tuple(r) for r in pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "spans", "scores", "base_sha256").collect()]
    assert sorted(got) == sorted(want)


def test_masking_keeps_rows_and_columns(spark):
    rows = [(1, "mail a@b.co now", 15, "p", "q", "r"), (2, None, None, "p", "q", None), (3, "clean", 5, "p", "q", "r"), (3, "clean", 5, "p", "q", "r"), (4, "", 0, "p", "q", "r"), (5, "x" * 100_000 + " a@b.co", 100_007, "p", "q", "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, __text string, __email string, spans string")
    out = pii.masked(df)
    assert out.columns == df.columns and pii.masked(df.limit(0)).collect() == []
    want = [(1, "mail <EMAIL> now", 16, "p", "q", "r"), *rows[1:5], (5, "x" * 100_000 + " <EMAIL>", 100_008, "p", "q", "r")]
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(want, key=str)


SECRETS = [
    "", None, "password=abc", "Password = 'abcdef'", 'API_KEY: "x+/=.-_1"', "apikey==abcdef token:token:abcdef", "AKIA" + "A" * 15, "xAKIA" + "A" * 16 + "é", "0123456789abcdef01234567", "g" + "a" * 24 + "g", "é😀 secret:abcdef\n" + "f" * 30,
    "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18, "xoxb-1234567890-ab", "secret " * 5000 + "secret=zzzzzz", "a" * 100_000, "PASSWD=aaaaaa", "AK IA",
]


def test_secrets_of_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(SECRETS)] + [(0, ""), (None, "token=abcdefg")]
    got = secret_scan.scan(rows_with_clashes(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = SECRETS[r["doc_id"]] if r["doc_id"] is not None else "token=abcdefg"
        check(r, text, base_secrets, ["assign", "access", "hex"])
        want = secret_scan.matches_by_rule(text or "")
        assert r["spans"] == ",".join(f"{k}:{s}:{e}" for s, _, e, k in want)
    assert secret_scan.scan(rows_with_clashes(spark, [])).collect() == []


def test_secrets_of_the_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = 0
    for r in queries.QUERIES["op8_secret_scan"](spark, SF).collect():
        check(r, texts[r["doc_id"]], base_secrets, ["assign", "access", "hex"])
        found += r["n_assign"] + r["n_access"] + r["n_hex"]
    assert found > 5


def test_trigram_queries_are_implied_by_matches():
    for rule in secret_scan.RULES:
        q = secret_scan.trigram_query(rule.pattern)
        for text in filter(None, SECRETS):
            if re.search(rule.pattern, text):
                holds = lambda q: q is True or (q in text.lower() if isinstance(q, str) else (all if q[0] == "and" else any)(holds(x) for x in q[1]))
                assert holds(q), (rule.kind, text)
    assert secret_scan.trigram_query("abc|x[yz]w") == ("or", frozenset({"abc", "xyw", "xzw"}))
    assert secret_scan.trigram_query("[0-9a-f]{24,}") is True


def expected_digest(turns):
    turns = [(r or "", t or "") for r, t in turns]
    loss = "".join(t for r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def test_chats_of_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    chats = {-1: [("user", queries.EXTRA), ("assistant", queries.EXTRA)]}
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        chats.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in queries.QUERIES["op5_chat_formatting"](spark, SF).collect()}
    assert got == {k: expected_digest(v) for k, v in chats.items()}


ODD = ["", None, "␛0<|turn|>␛", "<|end|><|say|>", "</s><s>[INST][/INST]", "␛5␛␛1", "<|image:0|>", "é😀\n", "<||end|>|>", "x" * 100_000]


def test_chats_with_control_strings_survive(spark):
    data = [(i, t, r, x, 1, "a") for i, x in enumerate(ODD) for t, r in ((0, "user"), (1, "assistant"), (2, None), (2, "assistant"))]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, k int, span string").withColumn("content", chat_format.text_part(F.col("text")))
    got = {r["conv_id"]: r for r in chat_format.digest(chat_format.formatted(df)).collect()}
    for i, x in enumerate(ODD):
        want = expected_digest([("user", x), ("assistant", x), (None, x), ("assistant", x)])
        assert tuple(got[i][c] for c in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256")) == want
    empty = df.limit(0)
    assert chat_format.formatted(empty).collect() == []


def test_parts_become_placeholders_with_tokens(spark):
    part = lambda **k: {"type": None, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None} | k
    content = [part(type="text", text="see <|image:9|> "), part(type="image", ref="a.png", width=600, height=512), part(type="audio", ref="b.wav", seconds=1.5), part(type="document", ref="c.pdf", pages=3), part(type="film"), part(type="text", text="end")]
    df = spark.createDataFrame([(1, 0, "user", content), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, content array<{chat_format.PART}>")
    out = chat_format.formatted(df).first()
    assert out["formatted"] == "<|turn|>user<|say|>see ␛1image:9|> <|image:1|><|audio:2|><|document:3|><|other:4|>end<|end|><|turn|>assistant<|say|><|end|>"
    assert [(a["turn"], a["part"], a["type"], a["ref"], a["tokens"]) for a in out["attachments"]] == [(0, 1, "image", "a.png", 85 + 170 * 2), (0, 2, "audio", "b.wav", 38), (0, 3, "document", "c.pdf", 1536), (0, 4, "film", None, 0)]
    start, end = out["mask"][0]["start"], out["mask"][0]["end"]
    assert out["formatted"][start:end] == "" and len(out["mask"]) == 1


def test_the_mask_is_read_by_its_places(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", "é😀x|" * (997 * (t % 4)) + f"[INST]{t}") for t in range(12)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("content", chat_format.text_part(F.col("text")))
    out = chat_format.formatted(df)
    whole = "".join(r[3] for r in rows if r[2] == "assistant")
    assert out.select(chat_format.loss_text(F.col("formatted"), F.col("mask"))).first()[0] == whole
    r = out.first()
    assert "".join(r["formatted"][m["start"] : m["end"]] for m in r["mask"]).replace("␛4", "[INST]") == whole
    moved = F.transform("mask", lambda m: F.struct((m["start"] + 1).alias("start"), (m["end"] + 1).alias("end")))
    assert out.select(chat_format.loss_text(F.col("formatted"), moved)).first()[0] != whole


def test_a_stored_index_serves_again(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(SECRETS)], "doc_id long, text string")
    index = secret_scan.build_index(secret_scan.keyed(docs))
    some = secret_scan.RULES[:4]
    for rules in (secret_scan.RULES, some):
        assert secret_scan.scan(docs, rules, index).collect() == secret_scan.scan(docs, rules).collect()


@pytest.mark.parametrize("name", ["op5_chat_formatting", "op7_pii", "op8_secret_scan"])
def test_native_operators_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_long_text_full_of_spans(spark):
    """Time grows with the text and its spans, not with their product: 10 MB with some 230,000 addresses."""
    n = 230_000
    texts = [" ".join(f"mail ü{k}.user{k}@host{k % 97}.example.com to others" for k in range(m)) for m in (300, n)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).cache()
    df.count()
    start = time.perf_counter()
    got = {r["doc_id"]: r for r in pii.scan(df).collect()}
    masked = {r["doc_id"]: r["text"] for r in pii.masked(df).collect()}
    took = time.perf_counter() - start
    assert [got[k]["n_email"] for k in (0, 1)] == [300, n] and took < 120
    assert got[1]["spans"].startswith(got[0]["spans"]) and got[1]["scores"].split(",").count("90") + got[1]["scores"].split(",").count("115") + got[1]["scores"].split(",").count("65") == n
    for k, m in ((0, 300), (1, n)):
        assert masked[k] == " ".join(["mail ü<EMAIL> to others"] * m)
    secrets = spark.createDataFrame([(1, " ".join(f"token = abc{k}xyz12345 word" for k in range(n)))], "doc_id long, text string")
    start = time.perf_counter()
    assert secret_scan.scan(secrets).first()["n_assign"] == n and time.perf_counter() - start < 60


def test_places_before_each_and_cut_out(spark):
    from roadlens.llm import spans

    rng = np.random.default_rng(1)
    rows = [(k, rng.integers(0, 9, n).tolist(), "añ\U0001f600\n"[k % 4] * 3 + "xyzé" * n) for k, n in enumerate([0, 1, 2, 255, 256, 257, 512, 1000])]
    df = spark.createDataFrame(rows, "k int, v array<int>, t string")
    out = df.select("k", spans.before_each(F.col("v"), F.lit(0), lambda a, x: a + x).alias("s"), spans.before_each(F.col("v"), F.lit(0), lambda a, x: F.greatest(a, x)).alias("m"), F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: spans.let(spans.pieces_of(F.col("t")), lambda p: spans.cut_out(p, i * 100, F.least(i * 150, F.length("t"))))).alias("c"))
    for r in out.collect():
        v, t = rows[r["k"]][1:]
        assert r["s"] == [sum(v[:i]) for i in range(len(v))] and r["m"] == [max(v[:i], default=0) for i in range(len(v))]
        assert r["c"] == [t[i * 100 : min(i * 150, len(t))] for i in range(7)]
