"""Personal data in texts: regular expressions propose, checksums confirm, context words weigh. DataFrame functions only.

All patterns run in time linear in the text and its spans: repeats are possessive, and a match may begin only where its run begins (or where the
match before ended), which changes no match of the base kinds. Account numbers are proposed from every place where one may
begin, in a window of bounded length, and may end at any word's end in it.

A span's score is its kind's prior, raised by words near it that speak for the kind and lowered by words that speak
against it. Added kinds count only from a score on, and masking leaves base kinds alone that do not reach it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread, unused
from .spans import before_each, cut_out, found, let, listed, number_of, pieces_of, tagged

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: A run of digits with single spaces or hyphens between. Shorter runs than a card's could only be dropped, so they are not matched.
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Added to the base kinds: account numbers with a mod-97 check. The match is the country only, so that no candidate hides
#: another; the group is the longest rest it may have and, if a word goes on there, that word's next character.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}(?=([0-9]{2}(?: ?[A-Z0-9]){11,30}+[A-Za-z0-9]?))"
SHORTEST, LONGEST = 15, 34
#: Lengths of the ISO 13616 registry. They only choose between ends that the check confirms; other countries need no entry.
REGISTERED = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OCTET = r"^(0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])\.){3}0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])$"
#: Also added: social security numbers, which no checksum confirms. A run of digits and hyphens is one as a whole or not at all.
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
SSN_ISSUED = r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
#: In hundredths: how likely a kind's match is personal data, by itself, and what words near it add or take.
PRIOR = {"email": 90, "ip": 60, "card": 80, "phone": 70, "iban": 90, "ssn": 40}
SUPPORT, CONTRARY = 25, -25
#: A span that was added to the base kinds needs this score, and so does any span to be masked.
LEAST = 50
#: Characters before and behind a span whose words count.
BEFORE, BEHIND = 48, 24
#: Words that make a kind likelier. Fixed lists, in English, German, Spanish and French, without accents.
CONTEXT = {
    "email": "mail e-mail email contact write reach kontakt schreiben correo contacto escribir courriel contacter ecrire",
    "ip": "ip address host server client login adresse rechner direccion servidor cliente serveur hote",
    "card": "card credit debit visa mastercard payment paid karte kreditkarte zahlung tarjeta credito pago carte bancaire paiement",
    "phone": "phone telephone tel call mobile cell fax telefon anrufen handy telefono llamar movil appeler portable",
    "iban": "iban account bank transfer konto ueberweisung cuenta banco transferencia compte banque virement",
    "ssn": "ssn social security taxpayer social-security sozialversicherung seguridad securite",
}
#: Words that make it less likely: numbers of other things look alike.
AGAINST = {
    "email": "example placeholder dummy",
    "ip": "version release build firmware section chapter v",
    "card": "order invoice tracking serial isbn article bestellung rechnung pedido factura commande facture",
    "phone": "order invoice serial model part article coordinates",
    "iban": "example placeholder dummy serial",
    "ssn": "order invoice part serial model article phone version",
}


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)
    at = lambda i: F.substring(back, (i + 1).cast("int"), F.lit(1)).cast("int")
    weigh = lambda i: F.when(i % 2 == 0, at(i)).when(at(i) > 4, at(i) * 2 - 9).otherwise(at(i) * 2)
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + weigh(i))
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number (no blanks) leaves 1 on division by 97."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(c == "", a).when(c.between("0", "9"), (a * 10 + value(c)) % 97).otherwise((a * 100 + value(c)) % 97))
    return rest == 1


def _account_numbers(text: Column) -> Column:
    """Spans of account numbers: at each beginning the end of its country's length or, if the check denies that, the last it confirms.

    Spans may overlap, but none lies within an earlier one.
    """
    whole = lambda s: F.concat(s["hit"], s["group"])
    bare = lambda s, n: F.replace(F.substring(whole(s), F.lit(1), n), F.lit(" "), F.lit(""))
    at_word_end = lambda s, n: F.regexp(F.substring(whole(s), n, F.lit(2)), F.lit("^[A-Z0-9] ?$"))
    lengths = F.create_map(*[F.lit(x) for n, countries in REGISTERED.items() for c in countries.split() for x in (c, n)])

    def ended(s: Column) -> Column:
        able = lambda n: at_word_end(s, n) & F.length(bare(s, n)).between(SHORTEST, LONGEST)
        ends = F.filter(F.filter(F.sequence(F.lit(SHORTEST), F.length(whole(s))), able), lambda n: mod97(bare(s, n)))
        usual = F.filter(ends, lambda n: F.length(bare(s, n)) == F.element_at(lengths, s["hit"]))
        return F.struct(s["start"].alias("start"), (s["start"] + F.coalesce(F.get(usual, F.lit(0)), F.array_max(ends))).alias("end"))

    spans = F.filter(F.transform(found(text, IBAN, group=1), ended), lambda s: s["end"].isNotNull())
    within = lambda s: let(before_each(s["end"], F.lit(0), lambda a, b: F.greatest(a, b)), lambda ends: F.filter(s, lambda x, k: x["end"] > F.get(ends, k)))
    return let(spans, within)


def near(words: str) -> str:
    """An expression for lower-case text that holds one of the words, whole."""
    return "(?:^|[^a-z0-9-])(?:" + "|".join(words.split()) + ")(?:[^a-z0-9-]|$)"


def _score(pieces: Column, size: Column, kind: str):
    """The kind's prior, moved by the words on either side of the span, in hundredths. pieces and size: of the text."""

    def score(s: Column) -> Column:
        before, behind = cut_out(pieces, F.greatest(s["start"] - BEFORE, F.lit(0)), s["start"]), cut_out(pieces, s["end"], F.least(s["end"] + BEHIND, size))
        around = F.translate(F.concat(before, F.lit("\n"), behind), UPPER, UPPER.lower())
        moved = lambda a, words, by: F.when(F.regexp(a, F.lit(near(words))), by).otherwise(0)
        return let(around, lambda a: F.lit(PRIOR[kind]) + moved(a, CONTEXT[kind], SUPPORT) + moved(a, AGAINST[kind], CONTRARY))

    return score


def spans_of(text: Column) -> Column:
    """An array of spans (start, rank, end, kind, base, score), sorted by start and kind; null texts count as empty.

    All matches of the base kinds are there, whatever their score; of the added kinds those whose score reaches LEAST.
    """
    text = F.coalesce(text, F.lit(""))
    proposed = {
        "email": found(text, EMAIL, guard=F.contains(text, F.lit("@"))),
        "ip": F.filter(found(text, IP), lambda s: F.regexp(s["hit"], F.lit(OCTET))),
        "card": F.filter(found(text, CARD), lambda s: (F.length(_digits(s["hit"])) <= 19) & luhn(_digits(s["hit"]))),
        "phone": F.filter(found(text, PHONE, guard=F.contains(text, F.lit("+"))), lambda s: F.length(_digits(s["hit"])).between(10, 15)),
        "iban": _account_numbers(text),
        "ssn": F.filter(found(text, SSN), lambda s: F.regexp(s["hit"], F.lit(SSN_ISSUED))),
    }
    likely = lambda spans, k: spans if k in BASE else F.filter(spans, lambda s: s["score"] >= LEAST)
    all_of = F.struct(*[proposed[k].alias(k) for k in KINDS])
    none = F.expr("cast(array() as array<struct<start: int, rank: int, end: int, kind: string, base: boolean, score: int>>)")

    def scored(t: Column) -> Column:
        tagged_ = [likely(tagged(t["found"][k], r, k, k in BASE, _score(t["pieces"], t["size"], k)), k) for r, k in enumerate(KINDS)]
        return F.array_sort(F.concat(*tagged_))

    some = lambda f: reduce(Column.__or__, [F.size(f[k]) > 0 for k in KINDS])
    return let(all_of, lambda f: F.when(some(f), let(F.struct(f.alias("found"), pieces_of(text).alias("pieces"), F.length(text).alias("size")), scored)).otherwise(none))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores: one row per row of docs.

    scores holds the score of each of the spans, in hundredths. A null text counts as empty; empty texts give no spans.
    Repeated rows give repeated rows, an empty table an empty one; other columns are not looked at, whatever their names.
    """
    seen = spread(docs.select("doc_id", "text")).select("doc_id", spans_of(F.col("text")).alias("all"))
    base = F.filter("all", lambda s: s["base"])
    counts = [number_of(F.col("all"), k).alias(f"n_{k}") for k in BASE]
    scores = F.concat_ws(",", F.transform("all", lambda s: s["score"].cast("string")))
    return seen.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"), scores.alias("scores"))


def masked(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """docs (all columns) with every span of at least that score replaced by <KIND> in text; n_chars follows if it is there.

    Spans that overlap are masked as one, under the name of the first. Null texts stay null, empty ones empty; a text
    without spans stays as it is. Rows that repeat stay so, an empty table stays empty; other columns may have any names.
    """
    name = unused(docs, "spans")
    seen = spread(docs).withColumn(name, F.filter(spans_of(F.col("text")), lambda s: s["score"] >= least))
    text, chosen = F.col("text"), F.col(name)

    def joined(t: Column) -> Column:
        # a span that begins before the end of one before it is part of that one's mask
        fresh = lambda ends: F.transform(t["spans"], lambda s, k: F.when(s["start"] >= F.get(ends, k), F.concat(cut_out(t["pieces"], F.get(ends, k), s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(""))
        parts = let(before_each(t["spans"]["end"], F.lit(0), lambda a, b: F.greatest(a, b)), fresh)
        return F.concat(F.array_join(parts, ""), cut_out(t["pieces"], F.array_max(t["spans"]["end"]), t["size"]))

    new = let(F.struct(chosen.alias("spans"), pieces_of(text).alias("pieces"), F.length(text).alias("size")), joined)
    out = seen.withColumn("text", F.when(F.size(chosen) == 0, text).otherwise(new))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(chosen) == 0, F.col("n_chars")).otherwise(F.length("text")).cast(dict(docs.dtypes)["n_chars"]))
    return out.drop(name)
