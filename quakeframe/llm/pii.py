"""Personal data: candidate spans scored by boosted trees.

Per document, native expressions find

* the base spans: the four fixed patterns with their validity tests, and
* candidates: wider, overlapping patterns of high recall (numbers without a
  plus sign, spelled-out addresses, keys and passwords, national numbers).

Every candidate gets features of its plain form and of the characters around it.
The plain form is without what only the fixed patterns ask for: no country code,
``@`` and ``.`` for spelled-out ones. So a base span looks to the trees like a
candidate that no fixed pattern knows, and is an example for it.

Gradient-boosted trees are trained on a bounded sample of all candidates. The
training label is weak and comes from evidence: base spans, check digits,
numbering plans, words before the candidate that name its kind, against words
that name something else, dates, and base spans of another kind. Candidates
without evidence have no label and are only scored. Each kind and label, on a
base span or not, weighs the same in training. A threshold for each kind is
calibrated on the labelled candidates that were not trained on: the lowest
score from which on the kept candidates are at least ``precision`` right. For
a kind with fewer than ``LEAST_HELD`` of these the evidence itself decides.
A candidate of label 1 whose check digits are right or whose kind is named before
it stays whatever its score, and one of label 0 is never added: forms too rare to
learn aren't lost or taken for others.
Redactions are the base spans, which always stay, and the candidates selected
that don't overlap a base span.

Everything on the path is DataFrame functions and JVM estimators.

Defined cases: null or empty text has no spans; repeated rows each give their
own row; a corpus without candidates of both labels skips the trees, and the
evidence decides; an empty table gives an empty result. Offsets are code points, end
exclusive. Long digit or letter runs are scanned in linear time (possessive
quantifiers that start only where a run starts).
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.llm.common import id_text, keyed_rows, materialize, own_names, row_key

# Each pattern matches what the contract's pattern matches. A match can only
# begin where the previous one ended (\G) or where no run of its own first
# class is under way, because from the middle of a run it fails or succeeds as
# from its start; possessive quantifiers drop backtracking that can't help.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IP_VALID = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"

#: Kinds in the order in which equal starts are listed.
KINDS = ("email", "ip", "card", "phone", "secret", "number")

# Spelled-out signs of addresses. Bare " at " needs a " dot " before a common last part.
_TLD = "com|org|net|edu|gov|info|biz|io|co|eu|uk|us|de|fr|es|it|nl|ch|at|be|pt|pl|se"
_AT = rf"(?: ?(?:@|(?i:\(at\)|\[at\]|\{{at\}})) ?| (?i:at) (?=[A-Za-z0-9-]++(?: (?i:dot) [A-Za-z0-9-]++){{0,3}}? (?i:dot) (?i:{_TLD})(?![A-Za-z0-9-])))"
_DOT = r"(?:\.| ?(?i:\(dot\)|\[dot\]|\{dot\}) ?| (?i:dot) )"
_IP_DOT = r"(?:\.|\[\.\]|\(\.\)|(?i:\[dot\]|\(dot\)))"

#: Countries by the length of their IBANs, so that none takes in the word after it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FO|GL|NL", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|XK", 21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA",
    23: "AE|GI|IL|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "PT", 26: "IS|TR", 27: "FR|GR|IT|MC|MR|SM", 28: "AL|AZ|CY|DO|GT|HU|LB|PL",
    29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU", 31: "MT|SC",
}
_IBAN = "|".join(rf"(?:{c})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())

#: Candidate generators: (kind, pattern, what a text must contain).
GENERATORS = (
    ("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)*+", r"(?i)@|[(\[{]at[)\]}]| dot "),
    ("ip", rf"(?:\G|(?<![0-9.]))[0-9]++(?:{_IP_DOT}[0-9]++){{3,}}+", r"(?i)[0-9][\[(]?(?:\.|dot)[\])]?[0-9]"),
    ("card", r"(?<![0-9])(?<![0-9][ .-])[0-9](?:[ .-]?[0-9]){11,18}+(?![ .-]?[0-9])", "[0-9]{4}"),
    ("phone", r"(?:\+|(?<![0-9A-Za-z+(.-])\(?)(?<![0-9][ .-])[0-9]{1,5}[)]?(?:(?:[ ./-]+\(?[0-9]{2,5}\)?){2,5}+|[ ./-]+[0-9]{6,8})(?![0-9]|[.-][0-9])", r"[0-9]{2}[ ()./-]"),
    ("secret", r"(?<![A-Za-z0-9])(?:[A-Z0-9]{16,}+|(?i:password|passwd|secret|token|api_?key)(?-i) ?[=:] ?\x22?[A-Za-z0-9+/_.-]++)", "[A-Z0-9]{16}|[=:]"),
    ("number", rf"(?<![0-9A-Za-z-])(?:[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}|(?:{_IBAN})(?![0-9A-Za-z-])|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?![0-9A-Za-z-])", "[0-9]{2}[- A-Z0-9][0-9A-Z]"),
)

#: The evidence for each kind, as SQL that gives 1, 0 or null (none): over the
#: match ``m``, its plain form, ``digits``, ``luhn``, ``check_ok``, ``named`` (a
#: word before it names the kind), ``other`` (one names something else),
#: ``same`` and ``differs`` (on a base span of its kind, of another kind).
EVIDENCE = {
    "email": r"CASE WHEN plain RLIKE '^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)*[.][A-Za-z]{2,}$' THEN 1 WHEN named = 1 THEN NULL ELSE 0 END",
    "ip": r"CASE WHEN plain RLIKE '^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])([.]|$)){4}$' AND NOT plain RLIKE '[.]$' THEN 1 ELSE 0 END",
    "card": "CASE WHEN luhn AND digits BETWEEN 13 AND 19 THEN 1 ELSE 0 END",
    "phone": r"""CASE WHEN same THEN 1 WHEN differs OR figures < 7 OR figures > 15 OR (luhn AND figures >= 12)
        OR m RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$' OR m RLIKE '^(19|20)[0-9]{2}[ ./-]+[0-9]{1,2}[ ./-]+[0-9]{1,2}$' OR m RLIKE '^[0-9]{1,2}[ ./-]+[0-9]{1,2}[ ./-]+(19|20)[0-9]{2}$' THEN 0
        WHEN named = 1 THEN 1 WHEN other = 1 THEN 0
        WHEN m RLIKE '^[(]0?[0-9]{2,4}[)]' AND digits BETWEEN 8 AND 12 THEN 1
        WHEN m RLIKE '^0[1-9][0-9]{0,3}[ ./-]' AND digits BETWEEN 9 AND 12 THEN 1
        WHEN m RLIKE '^[2-9][0-9]{2}[ .-][2-9][0-9]{2}[ .-][0-9]{4}$' THEN 1 END""",
    "secret": r"CASE WHEN (m RLIKE '[0-9]' AND m RLIKE '[A-Z]' AND char_length(m) >= 16) OR (m RLIKE '[=:]' AND regexp_extract(m, '[A-Za-z0-9+/_.-]+$', 0) RLIKE '[0-9]') THEN 1 ELSE 0 END",
    "number": r"""CASE WHEN m RLIKE '^[A-Z]' THEN CASE WHEN check_ok = 1 THEN 1 WHEN named = 1 THEN NULL ELSE 0 END
        WHEN m RLIKE '^(000|666|9[0-9]{2})-' OR m RLIKE '-00-' OR m RLIKE '-0000$' THEN 0
        WHEN other = 1 AND named = 0 THEN 0 ELSE 1 END""",
}

#: Fewer labelled candidates of a kind than this can't calibrate a threshold.
LEAST_HELD = 20

CONTEXT = 24
CUES = (
    ("cue_mail", "e-?mail|contact|write to|@"),
    ("cue_ip", "ip|address|host|server"),
    ("cue_card", "card|visa|credit|payment|account"),
    ("cue_phone", "phone|call|tel|mobile|fax"),
    ("cue_secret", "password|passwd|secret|token|key|login"),
    ("cue_number", "ssn|social|iban|passport|tax"),
)
#: Words that name a kind, and words that name something else, as whole words.
NAMED = {
    "email": "e-?mail|mail|contact|write to|reach|adresse|correo|courriel",
    "phone": "phone|telephone|call|tel|mobile|cell|fax|dial|ring|sms|text|whatsapp|hotline|telefon|handy|t[eé]l[eé]phone|tel[eé]fono|m[oó]vil|portable",
    "number": "ssn|social security|iban|passport|tax|account|konto|compte|cuenta",
}
OTHER = "order|invoice|version|release|build|isbn|issn|part|ref|reference|article|page|pages|section|chapter|model|serial|batch|item|lot|sku|ticket|case|id|date|from|until|since"
_FEATURES = (
    ["kind_id", "chars", "digits", "letters", "uppers", "dots", "dashes", "spaces", "parens", "equals", "distinct", "longest_digits", "octets_ok", "luhn_num", "check_ok", "before_space", "after_space", "after_punct", "named", "other"]
    + [c for c, _ in CUES]
)


def find_spans(text: Column, pattern: str, needs: str) -> Column:
    """All leftmost non-overlapping matches as (s, e, m). Offsets come from the
    pieces between matches, which ``split`` returns in the order in which
    ``regexp_extract_all`` returns the matches. Texts without ``needs`` (a
    cheaper pattern) are not scanned."""
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    empty = F.expr("CAST(array() AS ARRAY<STRUCT<s: INT, e: INT, m: STRING>>)")

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.char_length(x["g"])
        e = s + F.coalesce(F.char_length(x["m"]), F.lit(0))
        return F.struct(
            e.alias("at"),
            F.when(x["m"].isNull(), acc["out"])
            .otherwise(F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))))
            .alias("out"),
        )

    found = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return F.when(text.rlike(needs), found).otherwise(empty)


def _luhn(m: Column) -> Column:
    figures = F.regexp_extract_all(F.reverse(m), F.lit("[0-9]"), F.lit(0))
    parts = F.transform(
        figures,
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)
        ),
    )
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10 == 0


def _check_digits(m: Column) -> Column:
    """Whether an IBAN's check digits are right: its number, with the first four
    characters last and letters as 10 to 35, leaves 1 when divided by 97."""
    plain = F.regexp_replace(m, "[^0-9A-Z]+", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    values = F.transform(F.regexp_extract_all(turned, F.lit("[0-9A-Z]"), F.lit(0)), lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1)
    return F.aggregate(values, F.lit(0), lambda a, v: F.when(v < 10, a * 10 + v).otherwise(a * 100 + v) % 97) == 1


def _plain(m: Column) -> Column:
    """A candidate without what only the fixed patterns ask for."""
    email = F.regexp_replace(F.regexp_replace(m, r"(?i) ?(?:@|[(\[{]at[)\]}]) ?| at ", "@"), r"(?i) ?[(\[{]dot[)\]}] ?| dot ", ".")
    ip = F.regexp_replace(m, rf"{_IP_DOT}", ".")
    phone = F.regexp_replace(m, r"^\+[0-9]{1,3}(?=[ .(-])[ .-]*", "")
    k = F.col("k")
    return F.when(k == KINDS.index("email"), email).when(k == KINDS.index("ip"), ip).when(k == KINDS.index("phone"), phone).otherwise(m)


def _names(words: str) -> Column:
    return F.lower("before").rlike(rf"(?:^|[^\p{{L}}])(?:{words})(?:[^\p{{L}}]|$)").cast("int")


def _digits(m: Column) -> Column:
    return F.char_length(F.regexp_replace(m, "[^0-9]+", ""))


def base_spans(text: Column) -> dict[str, Column]:
    """The contract's spans of each kind, failing matches dropped."""
    return {
        "email": find_spans(text, EMAIL, "@"),
        "ip": F.filter(find_spans(text, IP, r"[0-9]\.[0-9]"), lambda x: x["m"].rlike(IP_VALID)),
        "card": F.filter(find_spans(text, CARD, r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]"), lambda x: _luhn(x["m"])),
        "phone": F.filter(find_spans(text, PHONE, r"\+[0-9]"), lambda x: _digits(x["m"]).between(9, 15)),
    }


def _span(kind: str):
    return lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), x["e"].alias("e"))


def _around(kind: str) -> Column:
    """The candidates of a kind with the characters around them: these travel
    with a candidate, the text does not."""

    def one(z: Column) -> Column:
        s, e = z["c"]["s"], z["c"]["e"]
        return F.struct(
            F.lit(KINDS.index(kind)).alias("k"),
            s.alias("s"),
            e.alias("e"),
            z["c"]["m"].alias("m"),
            F.substring(z["t"], F.greatest(s - CONTEXT, F.lit(0)) + 1, F.least(s, F.lit(CONTEXT))).alias("before"),
            F.substring(z["t"], e + 1, F.lit(1)).alias("after"),
        )

    c = F.col(f"c_{kind}")
    empty = F.expr("CAST(array() AS ARRAY<STRUCT<k: INT, s: INT, e: INT, m: STRING, before: STRING, after: STRING>>)")
    pairs = F.arrays_zip(c.alias("c"), F.array_repeat(F.col("text"), F.size(c)).alias("t"))
    return F.when(F.size(c) > 0, F.transform(pairs, one)).otherwise(empty)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, n_<kind>, base, candidates) of each document; no text."""
    d = id_text(docs)
    base = base_spans(F.col("text"))
    d = d.select("doc_id", row_key().alias("row_key"), "text", *[c.alias(f"b_{k}") for k, c in base.items()],
                 *[find_spans(F.col("text"), p, needs).alias(f"c_{k}") for k, p, needs in GENERATORS])
    around = [_around(k) for k, *_ in GENERATORS]
    spans = [F.transform(f"b_{k}", _span(k)) for k in base]
    return d.select(
        "doc_id",
        "row_key",
        *[F.size(f"b_{k}").cast("long").alias(f"n_{k}") for k in base],
        F.sort_array(F.concat(*spans)).alias("base"),
        F.concat(*around).alias("candidates"),
    )


def candidate_features(scanned: DataFrame) -> DataFrame:
    """One row per candidate with its features and weak label (null: none)."""
    c = scanned.select("doc_id", "row_key", "base", F.explode("candidates").alias("c")).select("doc_id", "row_key", "base", "c.*")
    c = c.withColumn("plain", _plain(F.col("m")))
    m, k = F.col("plain"), F.col("k")

    def count(body: str) -> Column:
        return F.char_length(F.regexp_replace(m, f"[^{body}]+", ""))

    def on_base(more) -> Column:
        return F.exists("base", lambda b: (b["s"] < F.col("e")) & (F.col("s") < b["e"]) & more(b))

    named = F.lit(0)
    for kind, words in NAMED.items():
        named = F.when(k == KINDS.index(kind), _names(words)).otherwise(named)
    c = c.select(
        "*",
        F.col("k").alias("kind_id"),
        F.char_length(m).alias("chars"),
        _digits(m).alias("digits"),
        _digits(F.col("m")).alias("figures"),
        count("A-Za-z").alias("letters"),
        count("A-Z").alias("uppers"),
        count(".").alias("dots"),
        count(r"\-").alias("dashes"),
        count(" ").alias("spaces"),
        count("()").alias("parens"),
        count("=:").alias("equals"),
        F.size(F.array_distinct(F.split(m, ""))).alias("distinct"),
        F.array_max(F.transform(F.split(m, "[^0-9]+", -1), lambda x: F.char_length(x))).alias("longest_digits"),
        m.rlike(IP_VALID).cast("int").alias("octets_ok"),
        _luhn(F.col("m")).alias("luhn"),
        F.when(k == KINDS.index("number"), _check_digits(m).cast("int")).otherwise(0).alias("check_ok"),
        F.col("before").rlike(r"[\x20\x09-\x0D\x22'(]$|^$").cast("int").alias("before_space"),
        F.col("after").rlike(r"^$|[\x20\x09-\x0D]").cast("int").alias("after_space"),
        F.col("after").rlike(r"^[.,;:!?\x22')]").cast("int").alias("after_punct"),
        *[F.lower("before").rlike(p).cast("int").alias(n) for n, p in CUES],
        named.alias("named"),
        _names(OTHER).alias("other"),
        on_base(lambda b: b["k"] == k).alias("same"),
        on_base(lambda b: b["k"] != k).alias("differs"),
    ).withColumn("luhn_num", F.col("luhn").cast("int"))
    label = F.lit(0)
    for kind, rule in EVIDENCE.items():
        label = F.when(k == KINDS.index(kind), F.expr(rule)).otherwise(label)
    return c.withColumn("label", label.cast("double"))


def _thresholds(held: DataFrame, precision: float) -> dict[int, float]:
    """Per kind with enough held-out candidates the lowest of 100 score steps from
    which on ``precision`` of them are right (2, which no score reaches, if there
    is none). At most 100 rows a kind come back."""
    step = F.least(F.floor(F.col("p") * 100), F.lit(99))
    rows = held.groupBy("k", step.alias("step")).agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()
    out = {}
    for k in range(len(KINDS)):
        steps = {r["step"]: r for r in rows if r["k"] == k}
        good = n = 0.0
        if sum(r["n"] for r in steps.values()) >= LEAST_HELD:
            out[k] = 2.0
            for step in sorted(steps, reverse=True):  # empty steps say nothing
                good, n = good + steps[step]["good"], n + steps[step]["n"]
                if good >= precision * n and step >= 50:
                    out[k] = step / 100
    return out


def choose(cands: DataFrame, max_train: int = 20_000, precision: float = 0.99, seed: int = 7) -> DataFrame:
    """(doc_id, row_key, s, k, e) of the candidates that the trees select.
    ``max_train``: the bound on the labelled candidates trained on, taken by their
    hash, equally many of each kind and label as far as there are; the labelled
    ones of the other half of the hashes, and no sample, calibrate the thresholds."""
    order = F.xxhash64("row_key", "s", "k", "e")
    clear = ~(F.col("same") | F.col("differs"))
    cands = cands.withColumn("order", order).withColumn("group", F.col("k") * 4 + F.col("label").cast("int") * 2 + clear.cast("int"))
    half = cands.where((F.col("order") % 2 == 0) & F.col("label").isNotNull())
    sizes = {r["group"]: r["n"] for r in half.groupBy("group").agg(F.count("*").alias("n")).collect()}  # 24 rows at most
    sure = cands.where(F.coalesce(F.col("label") == 1, F.lit(False)) & clear).select("doc_id", "row_key", "s", "k", "e")
    if len({g // 2 % 2 for g in sizes}) < 2:
        return sure
    quota = max(1, max_train // len(sizes))
    taken, weight = F.lit(0), F.lit(0.0)
    for g, n in sizes.items():
        taken = F.when(F.col("group") == g, int(min(1.0, quota / n) * (1 << 20))).otherwise(taken)
        weight = F.when(F.col("group") == g, 100.0 / min(n, quota)).otherwise(weight)
    train = half.where(F.pmod(F.shiftright("order", 1), F.lit(1 << 20)) < taken).withColumn("weight", weight)
    train = train.orderBy("order", "s").limit(max_train).select("label", "weight", *_FEATURES)
    if len(train.select("label").distinct().collect()) < 2:
        return sure
    assembler = VectorAssembler(inputCols=list(_FEATURES), outputCol="features")
    gbt = GBTClassifier(labelCol="label", weightCol="weight", maxIter=15, maxDepth=4, stepSize=0.3, seed=seed, cacheNodeIds=False)
    model = gbt.fit(assembler.transform(train.repartition(4)).select("label", "weight", "features"))
    scored = model.transform(assembler.transform(cands)).withColumn("p", vector_to_array("probability")[1])
    scored = scored.select("doc_id", "row_key", "same", "differs", "named", "check_ok", "s", "k", "e", "p", "label", "order")
    limits = _thresholds(scored.where((F.col("order") % 2 != 0) & F.col("label").isNotNull()), precision)
    keep = F.coalesce(F.col("label") == 1, F.lit(False))
    for k, least in limits.items():
        keep = F.when(F.col("k") == k, F.col("p") >= least).otherwise(keep)
    proven = F.coalesce(F.col("label") == 1, F.lit(False)) & ((F.col("named") == 1) | (F.col("check_ok") == 1))
    against = F.coalesce(F.col("label") == 0, F.lit(False))
    return scored.where((keep | proven) & ~against & clear).select("doc_id", "row_key", "s", "k", "e")


def pii_spans(docs: DataFrame, max_train: int = 20_000, precision: float = 0.99) -> DataFrame:
    """Per document: doc_id, row_key, counts of the base kinds, ``base`` and
    ``spans`` (arrays of start, kind index in ``KINDS``, end; sorted)."""
    found = materialize(scan(docs), "pii_scan")
    cands = materialize(candidate_features(found), "pii_candidates")
    added = choose(cands, max_train, precision).dropDuplicates(["row_key", "s", "k", "e"])
    extra = added.groupBy(F.col("row_key").alias("added_key")).agg(F.collect_list(F.struct("s", "k", "e")).alias("added"))
    joined = found.join(extra, F.col("row_key") == F.col("added_key"), "left")
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))
    return joined.select("doc_id", "row_key", "n_email", "n_ip", "n_card", "n_phone", "base", spans.alias("spans"))


def spans_text(c: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(c, lambda x: F.concat_ws(":", names[x["k"]], x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(docs: DataFrame, max_train: int = 20_000, precision: float = 0.99) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``[kind]``; overlapping
    spans are replaced together by the first one's kind. Null text stays null."""
    mine, other, found_spans, done_name = own_names(docs, "key", "span_key", "spans", "done")
    spans = pii_spans(docs, max_train, precision).where(F.size("spans") > 0)
    spans = spans.select(F.col("row_key").alias(other), F.col("spans").alias(found_spans)).dropDuplicates([other])
    joined = keyed_rows(docs, mine).join(spans, F.col(mine) == F.col(other), "left")
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    spread = F.arrays_zip(F.col(found_spans).alias("x"), F.array_repeat(F.col("text"), F.size(found_spans)).alias("t"))

    def step(acc: Column, z: Column) -> Column:
        gap = z["x"]["s"] - acc["at"]
        return F.struct(
            F.greatest(acc["at"], z["x"]["e"]).alias("at"),
            F.when(gap < 0, acc["out"])
            .otherwise(F.concat(acc["out"], F.array(F.substring(z["t"], acc["at"] + 1, gap), names[z["x"]["k"]])))
            .alias("out"),
        )

    done = F.aggregate(spread, F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS ARRAY<STRING>)").alias("out")), step)
    joined = joined.withColumn(done_name, F.when(F.col(found_spans).isNotNull(), done))
    parts = F.col(done_name)
    tail = F.substring(F.col("text"), parts["at"] + 1, F.char_length("text"))
    text = F.when(parts.isNull(), F.col("text")).otherwise(F.concat(F.array_join(parts["out"], ""), tail))
    return joined.withColumn("text", text).select(*docs.columns)
