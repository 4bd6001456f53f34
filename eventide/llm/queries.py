"""Registered queries of the ten operators, with production parameters, over
their whole tables; and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from eventide.llm import (bpe, chat_log, collocations, exact_dedup, filter_audit, fingerprint, mixing, near_dedup, quality, substring_dedup, suffix_dedup, toxicity,
                          urlfilter)
from eventide.llm.registry import ORACLES, QUERIES, register
from eventide.llm.textops import table

__all__ = ["ORACLES", "QUERIES"]

TOKENIZERS = "/opt/tokenizers"     # folder of the rank files; a parameter of the encoder
RANKS = "byte_bpe_50k.tiktoken"

# Rules (action, host and path); fixed values of the query.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
# Sites that are blocked with all their subdomains where no rule fits; an input of the query, for any table.
LISTED = urlfilter.read_sites(Path(__file__).with_name("listed_sites.txt"))

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"[^\x20\x09-\x0D]+"


def tokenizer() -> tuple[str, str]:
    """Path of the rank file and the pattern that splits text before the merges."""
    try:
        import public_tokenizers
        return public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    except ModuleNotFoundError:   # the module is the folder's own __init__.py
        import runpy
        return f"{TOKENIZERS}/{RANKS}", runpy.run_path(f"{TOKENIZERS}/__init__.py")["PATTERN"]


@register("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn_from_labels(docs, table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, lexicon)
            .select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")))


@register("op2_minhash_join")
def op2_minhash_join(spark, sf_dir):
    return near_dedup.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op3_exact_dedup", f"""
WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), {_AZ})) AS text_sha256,
                  translate(coalesce(text, ''), {_AZ}) AS norm FROM documents),
     g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM n JOIN g USING (norm)
""")
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@register("op4_suffix_array")
def op4_suffix_array(spark, sf_dir):
    return (suffix_dedup.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .withColumnRenamed("start", "start_word").withColumnRenamed("end", "end_word").withColumnRenamed("first_id", "first_doc_id"))


@register("op5_fm_index")
def op5_fm_index(spark, sf_dir):
    cut = substring_dedup.removed_words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def _rules_sql() -> str:
    rules = ", ".join(f"('{a}', '{t}', '{t.partition('/')[0]}', '/{t.partition('/')[2]}')" for a, t in RULES)
    listed = ", ".join(f"('{s}')" for s in LISTED)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
     p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_AZ}) AS host,
                  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
     r(action, rule, rhost, rpath) AS (VALUES {rules}),
     l(site) AS (VALUES {listed}),
     d AS (SELECT DISTINCT host, path FROM p),
     m AS (SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(action, length(rule)) AS action
           FROM d JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path),
     b AS (SELECT DISTINCT host FROM d JOIN l ON host = site OR ends_with(host, '.' || site))
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN b.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m USING (host, path) LEFT JOIN b USING (host)
"""


@register("op6_url_filter", _rules_sql())
def op6_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.verdicts(pages, urlfilter.entries(spark, RULES, LISTED)).drop("url")


@register("op7_quality")
def op7_quality(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    good, poor = (labels.where(F.col("quality") == q).select("doc_id") for q in (1, 0))
    return quality.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), good, poor=poor)


@register("op8_source_mix", rf"""
WITH d AS (SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
                  md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o FROM documents),
     s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
     r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM s),
     w AS (SELECT *, (rn - 1) % 3 + 1 AS w, 3 * source_size AS cap FROM r),
     l AS (SELECT *, CAST(cap AS DOUBLE) / w AS ratio FROM w),
     k AS (SELECT *, CAST((SELECT sum(source_size) FROM s)
                          - coalesce(sum(cap) OVER (ORDER BY ratio, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                          AS DOUBLE)
                     / sum(w) OVER (ORDER BY ratio, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam FROM l),
     t AS (SELECT source, source_size,
                  least((SELECT lam FROM k WHERE lam <= ratio ORDER BY ratio, rn LIMIT 1) * w, CAST(cap AS DOUBLE)) AS target
           FROM k),
     c AS (SELECT d.*, t.source_size, t.target,
                  coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, md5(coalesce(text, ''))
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
           FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
     e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM c)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0
            ELSE size * (whole + CASE WHEN before * 2 + size <= (target - whole * source_size) * 2 THEN 1 ELSE 0 END)
            END AS BIGINT) AS taken
FROM e
""")
def op8_source_mix(spark, sf_dir):
    # the table's own text is not needed beyond its size and as a tie-break
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                        F.col("_target").alias("target"), (F.col("_size") * F.col("_reps")).alias("taken"))


@register("op9_byte_bpe")
def op9_byte_bpe(spark, sf_dir):
    ranks, pattern = tokenizer()
    back = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern, bytes_col="bytes")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))


@register("op10_iblt_fingerprint")
def op10_iblt_fingerprint(spark, sf_dir):
    versions = fingerprint.with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return (fingerprint.compared(versions, "text", {"edited": ("edited_fingerprint", "near_edited"), "next_text": (None, "near_next")})
            .select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                    "fingerprint", "edited_fingerprint", "near_edited", "near_next"))


_CHAT_TEST = "</s>[INST] ok [/INST]"


@register("op12_chat_format", rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '{_CHAT_TEST}' UNION ALL SELECT -7, 1, 'assistant', '{_CHAT_TEST}'),
     e AS (SELECT *, regexp_replace(replace(text, '\', '\\'), '(\[|<)(/?s>|/?(?:INST|OUT|SYS|ROLE)\]|:\])', '\1\\\2', 'g') AS body,
                  regexp_replace(replace(role, '\', '\\'), '(\[|<)(/?s>|/?(?:INST|OUT|SYS|ROLE)\]|:\])', '\1\\\2', 'g') AS named FROM t),
     p AS (SELECT *, CASE role WHEN 'user' THEN '[INST] ' || body || ' [/INST]' WHEN 'assistant' THEN '[OUT] ' || body || '</s>'
                               WHEN 'system' THEN '[SYS] ' || body || ' [/SYS]' ELSE '[ROLE] ' || named || '[:]' || body || ' [/ROLE]' END AS piece FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(3 + sum(length(piece)) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
""")
def op12_chat_format(spark, sf_dir):
    table_turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tested = spark.range(2).select(F.lit(-7).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(_CHAT_TEST))
    log = chat_log.log_of_turns(table_turns.unionAll(tested))
    return chat_log.digests(chat_log.read_back(chat_log.render(chat_log.fold(log))))


@register("op11_filter_audit", rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
                     FROM documents),
     l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
     m AS (SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
                  CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
                  + 4 * CAST(100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) AS INT)
                  + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
                  + 16 * CAST(coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false) AS INT) AS mask
           FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
     c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
     f(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
     o AS (SELECT '' AS filter_order, 0 AS used, 0 AS k
           UNION ALL SELECT filter_order || name, used | bit, k + 1 FROM o JOIN f ON used & bit = 0 WHERE k < 5),
     s AS (SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit,
                  list_sum([0] || [1 << (ascii(filter_order[i]) - 65) FOR i IN range(1, step)])::INT AS gone
           FROM o, (SELECT unnest(range(1, 6))::INT AS step) WHERE k = 5),
     r AS (SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (gone | bit) = 0 THEN n ELSE 0 END) AS kept,
                  sum(CASE WHEN mask & bit > 0 AND mask & gone = 0 THEN n ELSE 0 END) AS removed,
                  sum(CASE WHEN mask & bit > 0 AND mask & gone > 0 THEN n ELSE 0 END) AS redundant,
                  sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
                  sum(CASE WHEN mask & bit > 0 AND mask & gone = 0 THEN good ELSE 0 END) AS good_lost,
                  sum(CASE WHEN mask & bit > 0 AND mask & gone = 0 THEN toxic ELSE 0 END) AS toxic_lost
           FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
""")
def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


@register("op13_collocations", rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), {_AZ}), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
     t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
     g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
     c AS (SELECT lang, w[i:i + k - 1] AS ws, count(*) AS f FROM g, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)
           GROUP BY lang, ws HAVING count(*) >= 30),
     a AS (SELECT lang, ws, f AS a, len(ws) AS m FROM c WHERE len(ws) >= 2),
     s AS (SELECT a.lang, a.ws, a.a, a.m, k, l.f AS l, r.f AS r, (2000000::HUGEINT * a.a) // (l.f + r.f) AS score
           FROM a, (SELECT unnest([1, 2, 3]) AS k), c AS l, c AS r
           WHERE k < a.m AND l.lang = a.lang AND r.lang = a.lang AND l.ws = a.ws[1:k] AND r.ws = a.ws[k + 1:a.m]),
     x AS (SELECT lang, ws, a, m, l, r, score FROM s QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
     i AS (SELECT lang, ws[b:b + k - 1] AS ws, max(a) AS f FROM a, (SELECT unnest([2, 3]) AS k), (SELECT unnest([1, 2, 3]) AS b)
           WHERE k < m AND b + k - 1 <= m GROUP BY ALL),
     y AS (SELECT x.*, array_to_string(x.ws, ' ') AS phrase FROM x LEFT JOIN i ON x.lang = i.lang AND x.ws = i.ws
           WHERE i.f IS NULL OR 100::HUGEINT * i.f < 80::HUGEINT * a),
     z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM y)
SELECT z.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM z JOIN t ON z.lang = t.lang WHERE rank <= 2000
""")
def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))
