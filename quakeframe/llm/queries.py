"""The registered queries of the text operators, thin over the operators: each
applies one to the whole ``documents`` table with production parameters and
derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.llm import bpe, fim, fingerprint, gam, line_dedup, ngram_join, packing, phrases, pii, quality, substring_dedup, tokens, toxicity
from quakeframe.llm.common import read_table


#: The contract's tokenizer file, sequence length and end id.
TOKENIZER = "word_bpe_49k.json"
CAPACITY, END_ID = 2048, 0


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select(
        "doc_id",
        F.col("line_dedup_lines").alias("n_lines"),
        F.col("line_dedup_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path(), CAPACITY, END_ID)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_shingles", "component_id")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pii.pii_spans(read_table(spark, sf_dir, "documents"))
    return d.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(pii.spans_text("base"), 256).alias("base_sha256"),
        pii.spans_text("spans").alias("spans"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents")))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.neighbour_report(read_table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality.quality(read_table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(read_table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op13_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_ngram_join": op3_ngram_join,
    "op4_pii": op4_pii,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_bpe": op6_bpe,
    "op7_fingerprint": op7_fingerprint,
    "op8_token_counts": op8_token_counts,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_fim": op11_fim,
    "op12_phrases": op12_phrases,
    "op13_quality_gam": op13_quality_gam,
}

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_WORDS = "list_filter(string_split_regex({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op3_ngram_join": f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w
),
n AS (SELECT w.doc_id, count(s.shingle) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
edges AS (SELECT x AS u, y AS v FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, e.v FROM reach r JOIN edges e ON r.v = e.u)
SELECT n.doc_id, any_value(n.n) AS n_shingles, min(r.v) AS component_id FROM n JOIN reach r ON r.u = n.doc_id GROUP BY 1""",
    "op5_substring_dedup": f"""WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS p FROM w WHERE len(ws) >= 35),
win AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 34], ' ')) AS h FROM p),
twice AS (SELECT doc_id, p FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM twice),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT w.doc_id, len(ws) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)""",
    "op1_line_dedup": f"""WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents)
),
often AS (
  SELECT key, max(doc_id) AS max_doc FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
  SELECT l.*, coalesce(l.doc_id < o.max_doc, false) AS gone FROM lines l LEFT JOIN often o USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op11_fim": """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
  SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d
),
f AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                   WHEN 'psm' THEN '<P>' || substring(t, 1, lo) || '<S>' || substring(t, hi + 1) || '<M>' || substring(t, lo + 1, hi - lo)
                   ELSE '<S>' || substring(t, hi + 1) || '<P>' || substring(t, 1, lo) || '<M>' || substring(t, lo + 1, hi - lo) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f""",
    "op12_phrases": f"""WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
),
w AS (SELECT lang, row_number() OVER () AS pid, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
u AS (SELECT lang, pid, unnest(ws) AS w1, unnest(range(len(ws))) AS i FROM w),
s AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM u WINDOW o AS (PARTITION BY pid ORDER BY i)),
g AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM s
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM s WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM s WHERE w3 IS NOT NULL
),
f AS MATERIALIZED (SELECT lang, k, phrase, lang || chr(10) || phrase AS key, string_split(phrase, ' ') AS ws, count(*) AS f FROM g GROUP BY 1, 2, 3),
tot AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
cand AS (SELECT * FROM f WHERE k >= 2 AND f >= 10),
cut1 AS (SELECT lang, k, phrase, ws, f AS a, unnest(range(1, k)) AS cut FROM cand),
cuts AS (
  SELECT *, lang || chr(10) || array_to_string(ws[1:cut], ' ') AS first, lang || chr(10) || array_to_string(ws[cut + 1:], ' ') AS rest FROM cut1
),
scored AS (
  SELECT c.*, x.f AS l, y.f AS r, CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.key = c.first JOIN f y ON y.key = c.rest
),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, f FROM cand WHERE k = 3
  UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), f FROM cand WHERE k = 3
),
around AS (SELECT lang, phrase, max(f) AS most FROM inside GROUP BY 1, 2),
kept AS (SELECT low.* FROM low LEFT JOIN around USING (lang, phrase) WHERE coalesce(100 * around.most, 0) < 50 * low.a),
best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept QUALIFY rank <= 2000)
SELECT b.lang, b.rank, b.phrase, b.a, b.l, b.r, tot.n, b.score FROM best b JOIN tot USING (lang)""",
}
