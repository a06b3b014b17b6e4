"""Personal data by weak supervision (operator 2); DataFrame functions only.

Regular expressions cut candidate spans out of every whole text: what the base rules look at (whether it
passes them or not) and further shapes. Labelers vote 1, -1 or abstain on each candidate: format rules and
checksums, gazetteers of prefixes and endings, gazetteers of cue words by kind and of words about other
numbers, the characters next to the span, and what the text around it is made of. Expectation-maximisation
over the counts of vote patterns (a small table whatever the corpus) estimates, for data and for the rest,
how often each labeler votes each way or abstains. The resulting soft labels train a naive Bayes span
classifier on the span's own features and the words around it. It alone decides on the candidates that no
base rule settles: those of probability ``LEAST`` or more are added. Base spans always stay.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import materialize

BASE = ("email", "ip", "card", "phone")
#: Kinds of candidates of a base shape that fail the base rule carry a name of their own.
LIKELY = {"card": "likely_card", "phone": "likely_phone", "ip": "likely_ip"}
KINDS = (*BASE, *LIKELY.values(), "ssn", "local_phone", "hidden_email", "iban")
AROUND = 48  # characters of context on either side
ROUNDS = 15
LEAST = 0.9  # probability that an added span needs
WORDS = 1024  # buckets that words around a span, and shapes, are hashed to
#: Java patterns with the same leftmost non-overlapping matches as the base rules, without backtracking:
#: a match starts where a run starts, or where the last match ended. Of digit runs, only those of 14 to 19 digits match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "number": r"(?<![A-Za-z0-9.+-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4})(?![0-9-])",
    "hidden_email": r"(?<![A-Za-z0-9._-])[A-Za-z0-9][A-Za-z0-9._-]*+ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++(?:(?: ?[\[(](?:dot|DOT)[\])] ?|\.)[A-Za-z0-9-]++)++",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
#: Quick tests that a text needs to pass before its pattern is tried.
HINTS = {
    "email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?+[0-9]){13}", "phone": r"\+[0-9]", "number": r"[0-9]{3}\)?[ .-][0-9]{2,3}[.-][0-9]",
    "hidden_email": r"[\[(](?:at|AT)[\])]", "iban": r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}",
}
#: Gazetteers of cue words near each kind of data, in the languages of the corpora (fixed values).
CUES = {
    "mail": r"e-?mail|mail|mailto|contact|write to|reach me|kontakt|schreib|courriel|écris|contacte|correo|escribe",
    "phone": r"phone|tel|telephone|call|mobile|cell|fax|sms|whatsapp|dial|telefon|anruf|ruf|handy|téléphone|appelez|portable|teléfono|llame|móvil",
    "card": r"card|credit|debit|visa|mastercard|amex|karte|kreditkarte|carte|tarjeta|cvv|expires|expiry",
    "network": r"ip|ipv4|host|address|adresse|dirección|client|peer|login|logged|server|from",
    "identity": r"ssn|social security|identity|passport|national id|taxpayer|born|ausweis|sozialversicherung|sécurité sociale|dni|seguridad social",
    "bank": r"iban|account|bank|transfer|konto|überweisung|compte|virement|cuenta|transferencia",
}
CUE_OF = {"email": "mail", "hidden_email": "mail", "phone": "phone", "likely_phone": "phone", "local_phone": "phone", "card": "card", "likely_card": "card", "ip": "network", "likely_ip": "network", "ssn": "identity", "iban": "bank"}
#: Words near numbers that are not personal data (fixed values).
OTHER = r"isbn|issn|doi|invoice|order|orders|version|release|build|part|serial|sku|article|page|figure|table|section|chapter|total|price|year|id|no|number|ref|tracking|rechnung|bestellung|artikel|seite|facture|commande|article|factura|pedido|página|barcode|ean"
#: Ends of domain names, countries of account numbers, calling codes and first digits of cards (fixed values).
ENDINGS = r"(?i)(?:^|[.\])] ?)(?:com|org|net|edu|gov|info|io|biz|eu|de|fr|es|it|nl|uk|us|ch|at|be|pl|se|no|dk|fi|pt|ca|au|jp|cn|in|br|mx|ru|name|dev|app|co)$"
COUNTRIES = r"^(?:AD|AT|BE|BG|CH|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IS|IT|LI|LT|LU|LV|MC|MT|NL|NO|PL|PT|RO|SE|SI|SK|SM|TR)"
CALLING = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|30|3[68]|6(?:011|5|4))"
LABELERS = ("rule", "prefix", "cue", "other", "edges", "prose")
VOTES = (1, 0, -1)
#: How often a labeler is thought to vote 1, 0 and -1 at first, for data and for the rest; also the pseudo-votes of each round.
START = ((0.6, 0.3, 0.1), (0.2, 0.3, 0.5))


def octet_ok(m: Column) -> Column:
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    return m.rlike(rf"^{part}(?:\.{part}){{3}}$")


def luhn_ok(m: Column) -> Column:
    digits = F.reverse(F.regexp_replace(m, "[^0-9]", ""))

    def value(i: Column) -> Column:
        d = F.substring(digits, i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def digits_in(m: Column) -> Column:
    return F.length(F.regexp_replace(m, "[^0-9]", ""))


def iban_ok(m: Column) -> Column:
    """The checksum of account numbers: the number read with its first four characters last, letters as 10 to 35, is 1 modulo 97."""
    plain = F.regexp_replace(m, " ", "")
    chars = F.concat(F.substring(plain, 5, 64), F.left(plain, F.lit(4)))
    value = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(chars, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise((a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97)) == 1


def piece(kind: str):
    """What a match (the last has none) and the gap before it give."""
    return lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("at"), F.length(x["g"]).alias("gap"), x["m"].alias("match"), F.right(x["g"], F.lit(AROUND)).alias("left"), F.left(x["g"], F.lit(AROUND)).alias("head")
    )


def candidates(docs: DataFrame) -> DataFrame:
    """``(id, print, kind, start, stop, match, left, right)`` of every candidate span of ``docs(id, text)``."""
    text = F.col("text")
    found = []
    for kind, pattern in PATTERNS.items():
        matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
        pieces = F.transform(F.arrays_zip(gaps.alias("g"), matches.alias("m")), piece(kind))
        found.append(F.when(text.rlike(HINTS[kind]), pieces).otherwise(F.array().cast("array<struct<kind:string,at:int,gap:int,match:string,left:string,head:string>>")))
    rows = docs.select("id", F.xxhash64("text").alias("print"), F.explode(F.concat(*found)).alias("p")).select("id", "print", "p.*")
    rows = materialize(rows.dropDuplicates(["id", "print", "kind", "at"]))  # repeated rows count once here
    order = Window.partitionBy("id", "print", "kind").orderBy("at")
    step = F.col("gap") + F.coalesce(F.length("match"), F.lit(0))
    rows = rows.withColumn("stop", F.sum(step).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.withColumn("right", F.coalesce(F.lead("head").over(order), F.lit(""))).where("match is not null")
    shape = F.when(F.col("match").rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn").otherwise("local_phone")
    kind = F.when(F.col("kind") == "number", shape).otherwise(F.col("kind"))
    return rows.select("id", "print", kind.alias("kind"), (F.col("stop") - F.length("match")).alias("start"), "stop", "match", "left", "right")


def near_word(words: str) -> str:
    return rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{words})(?![\p{{L}}\p{{N}}])"


def voted(spans: DataFrame) -> DataFrame:
    """Spans with ``base`` (a base rule holds; else candidates of base kinds are renamed) and one vote of 1, 0 (abstains) or -1 for each labeler."""
    m, n = F.col("match"), digits_in(F.col("match"))
    kind = lambda *k: F.col("kind").isin(*k)
    base = kind("email") | (kind("ip") & octet_ok(m)) | (kind("card") & n.between(14, 19) & luhn_ok(m)) | (kind("phone") & n.between(10, 15))
    spans = spans.withColumn("base", base)
    renamed = F.when(F.col("base"), F.col("kind"))
    for k, name in LIKELY.items():
        renamed = renamed.when(F.col("kind") == k, name)
    spans = spans.withColumn("kind", renamed.otherwise(F.col("kind")))
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    check = lambda ok: F.when(ok, 1).otherwise(-1)
    none = F.lit(False)
    cue = F.lit(False)
    near = F.concat_ws(" ", "left", F.left("right", F.lit(AROUND // 2)))
    for name, words in CUES.items():
        cue = cue | (kind(*[k for k, c in CUE_OF.items() if c == name]) & near.rlike(near_word(words)))
    rule = (
        F.when(kind("ssn"), check(~m.rlike(r"^(?:000|666|9)") & ~m.rlike("-00-") & ~m.rlike("-0000$")))
        .when(kind("local_phone"), check(m.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-][2-9]")))
        .when(kind("hidden_email"), check(m.rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*[A-Za-z0-9]? ?[\[(]") & m.rlike(r"[A-Za-z]{2,}$")))
        .when(kind("iban"), check(iban_ok(m)))
        .otherwise(check(F.col("base")))
    )
    prefix = (
        F.when(kind("email", "hidden_email"), F.when(m.rlike(ENDINGS), 1).otherwise(-1))
        .when(kind("phone", "likely_phone"), check(m.rlike(CALLING)))
        .when(kind("card", "likely_card"), check(m.rlike(ISSUERS)))
        .when(kind("iban"), check(m.rlike(COUNTRIES)))
        .when(kind("ip", "likely_ip"), vote(none, m.rlike(r"^0") | m.rlike(r"(^|\.)0[0-9]")))
        .otherwise(0)
    )
    before, after = F.col("left").rlike(r"(^|[\s:;,(\[<\"'])$"), F.col("right").rlike(r"^($|[\s;,.!?)\]>\"'])")
    glued = F.col("left").rlike(r"[\p{L}\p{N}=/_#$-]$") | F.col("right").rlike(r"^[\p{L}\p{N}=/_#%$-]")
    around = F.concat("left", "right")
    share = lambda c: F.length(F.regexp_replace(around, c, "")) / F.greatest(F.length(around), F.lit(1))
    return spans.withColumns(
        {
            "rule": rule,
            "prefix": prefix,
            "cue": vote(cue, none),
            "other": vote(none, F.right("left", F.lit(AROUND // 2)).rlike(near_word(OTHER))),
            "edges": vote(before & after, glued),
            "prose": F.when(F.length(F.trim(around)) == 0, 0).otherwise(vote(share(r"[^\p{L}\s]+") >= 0.8, share(r"[^0-9]+") >= 0.3)),
        }
    )


def apart(spans: DataFrame) -> DataFrame:
    """Base spans, and the candidates that overlap none of them."""
    order = Window.partitionBy("id", "print").orderBy("start", F.desc("base"))
    before = F.max(F.when(F.col("base"), F.col("stop"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    spans = spans.withColumns({"earlier": before, "later": after}).where("base or (coalesce(earlier, 0) <= start and coalesce(later, stop) >= stop)")
    return spans.drop("earlier", "later")


def told() -> Column:
    """What is known of a span before its features: its kind, and each labeler's vote."""
    return F.array(F.concat(F.lit("kind="), "kind"), *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in LABELERS])


def probability(keys: Column, gains: dict[str, float]) -> Column:
    """Probability that a span is personal data, from the log-odds of what is told of it."""
    table = F.create_map(*[F.lit(x) for pair in gains.items() for x in pair])
    return 1 / (1 + F.exp(-F.aggregate(keys, F.lit(0.0), lambda a, k: a + F.coalesce(F.try_element_at(table, k), F.lit(0.0)))))


def log_odds(priors: dict[str, float], rates: dict[str, tuple]) -> dict[str, float]:
    """Log-odds of each kind and vote; ``rates``: how often each labeler votes 1, 0 and -1, for data and for the rest."""
    gains = {f"kind={k}": log(p / (1 - p)) for k, p in priors.items()}
    return gains | {f"{name}={v}": log(p / q) for name, (data, rest) in rates.items() for v, p, q in zip(VOTES, data, rest, strict=True)}


def reliabilities(votes: DataFrame) -> tuple[dict[str, float], dict[str, tuple]]:
    """Expectation-maximisation over the table of vote patterns (3^6 for each kind at most); each round is one aggregation.

    A labeler that never votes one way keeps its starting rates there only as two pseudo-votes; abstention counts as a way to vote.
    """
    patterns = materialize(votes.groupBy(told().alias("keys")).agg(F.count("*").alias("n")))
    priors, rates = dict.fromkeys(KINDS, 0.5), dict.fromkeys(LABELERS, START)
    for _ in range(ROUNDS):
        soft = patterns.select("n", probability(F.col("keys"), log_odds(priors, rates)).alias("p"), F.explode("keys").alias("key"))
        # a row for each kind and each way to vote
        sums = {r["key"]: (r["p"], r["q"]) for r in soft.groupBy("key").agg(F.sum(F.col("n") * F.col("p")).alias("p"), F.sum(F.col("n") * (1 - F.col("p"))).alias("q")).collect()}
        seen = lambda key, c: sums.get(key, (0.0, 0.0))[c]  # noqa: E731, B023
        priors = {k: (seen(f"kind={k}", 0) + 1) / (seen(f"kind={k}", 0) + seen(f"kind={k}", 1) + 2) for k in KINDS}

        def rate(name: str, c: int, seen=seen) -> tuple:
            n = [seen(f"{name}={v}", c) + 2 * x for v, x in zip(VOTES, START[c], strict=True)]
            return tuple(x / sum(n) for x in n)

        rates = {k: (rate(k, 0), rate(k, 1)) for k in LABELERS}
    return priors, rates


def features() -> dict[str, Column]:
    """Discrete features of a span and of the words around it; each has a bounded number of values."""
    m, bucket = F.col("match"), lambda c: F.pmod(F.xxhash64(c), F.lit(WORDS)).cast("string")
    word = lambda c, n: F.lower(F.regexp_extract(c, n, 1))
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(m, "[0-9]", "0"), "[A-Z]+", "A"), "[a-z]+", "a")
    sign = lambda c: F.regexp_replace(F.regexp_replace(c, r"[\p{L}]", "a"), "[0-9]", "0")
    return {
        "kind": F.col("kind"),
        "shape": F.concat_ws(" ", "kind", bucket(shape)),
        "valid": F.concat_ws(" ", "kind", F.col("rule").cast("string"), F.col("prefix").cast("string")),
        "size": F.least(F.floor(F.length(m) / 4), F.lit(10)).cast("string"),
        "before": sign(F.right("left", F.lit(1))),
        "after": sign(F.left("right", F.lit(1))),
        "word_before": F.concat_ws(" ", F.when(F.col("cue") == 1, "cue").otherwise("-"), bucket(word("left", r"(\p{L}+)[^\p{L}]*$"))),
        "second_before": bucket(word("left", r"(\p{L}+)[^\p{L}]+\p{L}+[^\p{L}]*$")),
        "word_after": bucket(word("right", r"^[^\p{L}]*(\p{L}+)")),
        "others": F.col("other").cast("string"),
        "digits": F.least(F.floor(F.length(F.regexp_replace(F.concat("left", "right"), "[^0-9]+", "")) / 4), F.lit(8)).cast("string"),
    }


def classified(votes: DataFrame, priors: dict[str, float], rates: dict[str, tuple]) -> DataFrame:
    """``votes`` with ``chance``: the probability that naive Bayes, trained on the soft labels, gives each span."""
    feats = features()
    soft = votes.withColumn("p", probability(told(), log_odds(priors, rates)))
    value = F.array(*[F.concat(F.lit(k + "="), F.coalesce(f, F.lit(""))) for k, f in feats.items()])
    table = soft.select("p", F.explode(value).alias("value")).groupBy("value").agg(F.sum("p").alias("p"), F.sum(1 - F.col("p")).alias("q"))
    total = soft.agg(F.sum("p").alias("all_p"), F.sum(1 - F.col("p")).alias("all_q"))
    # smoothed towards the value's share among all spans, so that a rare value alone tells nothing
    share = 2 * (F.col("p") + F.col("q")) / (F.col("all_p") + F.col("all_q"))
    gain = F.log((F.col("p") + share) / (F.col("all_p") + 2)) - F.log((F.col("q") + share) / (F.col("all_q") + 2))
    # one row: a map of no more values than the features have, and the log-odds of all spans
    gains = table.crossJoin(F.broadcast(total)).agg(F.map_from_entries(F.collect_list(F.struct("value", gain.alias("g")))).alias("gains"), F.first(F.log((F.col("all_p") + 1) / (F.col("all_q") + 1))).alias("bias"))
    score = F.aggregate(value, F.col("bias"), lambda a, x: a + F.coalesce(F.try_element_at("gains", x), F.lit(0.0)))
    return votes.crossJoin(F.broadcast(gains)).withColumn("chance", 1 / (1 + F.exp(-score))).drop("gains", "bias")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``, one row for each row of ``docs``.

    A null text counts as empty. Repeated rows repeat their result. Other columns are ignored. Spans
    are code points, end exclusive; ties in start go by kind. Added spans don't overlap base spans.
    No rows give no rows.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    votes = materialize(apart(voted(candidates(docs))))
    decided = classified(votes, *reliabilities(votes))
    kept = decided.where(F.col("base") | (F.col("chance") >= LEAST))

    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    label = F.concat_ws(":", "kind", "start", "stop")
    n = lambda k: F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}")
    joined = lambda some: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(some, F.struct(F.col("start"), rank.alias("rank"), label.alias("label"))))), lambda x: x["label"]), ",")
    by_doc = kept.groupBy("id", "print").agg(*[n(k) for k in BASE], joined(F.col("base")).alias("base"), joined(F.lit(True)).alias("spans"))
    by_doc = by_doc.withColumnsRenamed({"id": "same", "print": "same_print"})
    out = docs.select("id", F.xxhash64("text").alias("print")).join(by_doc, F.col("id").eqNullSafe(F.col("same")) & (F.col("print") == F.col("same_print")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return out.select("id", *[zero(f"n_{k}") for k in BASE], F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
