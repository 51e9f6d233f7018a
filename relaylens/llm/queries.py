"""The registered queries of the text operators and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (conversation_repair, decontamination, fingerprint, language_id, pii, quality_classifier, quality_rules, sentencepiece, simhash,
               source_divergence, substring_dedup, token_output, url_filter)
from .common import freeze, kept_in_worker, read_table, scratch_folder

QUERIES: dict = {}
ORACLES: dict = {}

#: Vocabulary files of public tokenizers.
WORD_BPE, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("op8_simhash")
def op8_simhash(spark, sf_dir):
    """Near-duplicate component of every document (3-word shingles, 2 bits)."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, limit=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

URL_SQL = r"""
WITH rules(action, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
numbered AS (SELECT row_number() OVER () AS n, * FROM split),
best AS (
  SELECT n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.action, length(r.host || r.path)) AS action
  FROM numbered s JOIN rules r
    ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM numbered LEFT JOIN best USING (n)
"""


@register("op9_url_filter", URL_SQL)
def op9_url_filter(spark, sf_dir):
    """Allow or block verdict of every page url by the longest fitting rule."""
    judged = url_filter.judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM d, unnest(range(1, len(w) - 11)) t(i)),
firsts AS (SELECT s, min(doc_id) AS f FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN firsts USING (s), unnest(range(13)) r(k) WHERE f < doc_id),
words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) t(p)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@register("op1_substring_dedup", SUBSTRING_SQL)
def op1_substring_dedup(spark, sf_dir):
    """Words left in every document after removing repeated 13-word windows."""
    left = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), width=13)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: 11 of 13 equal tokens leave a run of at least 4, which finds the alignments here.
LEAK_SQL = r"""
WITH cut AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
items AS (SELECT w AS iw, min(item_id) AS item_id FROM cut WHERE len(w) >= 13 GROUP BY w),
docs AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS dw FROM documents),
ig AS (SELECT item_id, i, array_to_string(iw[i:i + 3], ' ') AS g FROM items, unnest(range(1, len(iw) - 2)) t(i)),
dg AS (SELECT doc_id, i, array_to_string(dw[i:i + 3], ' ') AS g FROM docs, unnest(range(1, len(dw) - 2)) t(i)),
lines AS (SELECT DISTINCT doc_id, item_id, dg.i - ig.i AS shift FROM dg JOIN ig USING (g)),
win AS (SELECT doc_id, item_id, shift + k - 1 AS start, list_sum(list_transform(range(13),
          lambda j: CASE WHEN iw[k + j] = dw[shift + k + j] THEN 1 ELSE 0 END)) AS n
        FROM lines JOIN items USING (item_id) JOIN docs USING (doc_id),
             unnest(range(greatest(1, 1 - shift), least(len(iw), len(dw) - shift) - 11)) t(k)),
best AS (SELECT doc_id, item_id, max(n) AS n_equal FROM win WHERE n >= 11 GROUP BY ALL)
SELECT doc_id, item_id, CAST(n_equal AS INTEGER) AS n_equal, CAST(min(start) AS INTEGER) AS start
FROM best JOIN win USING (doc_id, item_id) WHERE n = n_equal GROUP BY ALL
"""


@register("op3_decontamination", LEAK_SQL)
def op3_decontamination(spark, sf_dir):
    """Every document and benchmark item that share a window of 13 tokens, 11 of them equal."""
    return decontamination.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                      window=13, share=0.8).drop("text_key")


def word_tokenizer():
    import public_tokenizers
    path = public_tokenizers.path(WORD_BPE)
    return kept_in_worker(("word_encoder", path), lambda: token_output.word_encoder(path))


@register("op2_token_output")
def op2_token_output(spark, sf_dir):
    """Place, length and checksum of every document's ids, as read back from the written files."""
    folder = scratch_folder(spark, "op2_tokens")
    token_output.write_tokens(read_table(spark, sf_dir, "documents"), folder, word_tokenizer, end_id=2)
    back = token_output.read_tokens(spark, folder)
    return back.select("doc_id", "start", "n_tokens", F.col("crc32").alias("ids_crc32"))


@register("op4_quality_rules")
def op4_quality_rules(spark, sf_dir):
    """Rule counts of every document and the verdict by divergence from language references."""
    docs = read_table(spark, sf_dir, "documents")
    judged = quality_rules.judge(docs.select("doc_id", "text"), quality_rules.build_references(docs))
    return judged.select("doc_id", "quality.*")


def fold(doc_id, folds: int):
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


@register("op10_quality_classifier")
def op10_quality_classifier(spark, sf_dir):
    """Score of every document by trees fitted on the labels outside the held-out fold."""
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = quality_classifier.fit_quality(docs, labels, usable=fold(F.col("doc_id"), 3) != 1)
    scored = quality_classifier.score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op6_language_id")
def op6_language_id(spark, sf_dir):
    """Language of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.fit_languages(docs, usable=fold(F.col("doc_id"), 5) != 0)
    found = language_id.predict_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
                        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def piece_model(spark):
    import public_tokenizers
    return sentencepiece.share_model(spark, public_tokenizers.path(PIECES))


def encoded(docs, model):
    """``docs`` with its pieces, their number and checksum, and the text that they decode to."""
    coded = sentencepiece.round_trip(docs, model)
    return coded.withColumns({
        "n_pieces": F.coalesce(F.size("pieces"), F.lit(0)).cast("bigint"),
        "round_trip": F.col("decoded").eqNullSafe(F.col("text")),
        "pieces_sha256": F.sha2(F.array_join("pieces", ","), 256), "decoded_sha256": F.sha2("decoded", 256)})


@register("op7_sentencepiece")
def op7_sentencepiece(spark, sf_dir):
    """Pieces of every document on its best path, and whether they decode to the text."""
    coded = encoded(read_table(spark, sf_dir, "documents").select("doc_id", "text"), piece_model(spark))
    return coded.select("doc_id", "n_pieces", "pieces_sha256", "decoded_sha256", "round_trip")


@register("op5_pii")
def op5_pii(spark, sf_dir):
    """Personal data in every document: pattern spans, and those that the tagger adds."""
    docs = read_table(spark, sf_dir, "documents")
    found = pii.find_pii(docs.select("doc_id", "text"), pii.fit_tagger(docs))
    return found.select("doc_id", *(f"pii.n_{k}" for k in pii.KINDS), F.sha2("pii.base", 256).alias("base_sha256"),
                        "pii.spans", F.col("pii.base").alias("base_spans"))


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
groups AS (SELECT DISTINCT lang, source FROM d),
langs AS (SELECT lang, CAST(count(term) AS HUGEINT) AS v, coalesce(sum(lang_n), 0) AS lang_total
          FROM (SELECT DISTINCT lang FROM groups) LEFT JOIN kept USING (lang) GROUP BY lang),
counts AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
                  1 + (1000000000 * (coalesce(n, 0) + 2)) // (g.total + 2 * l.v) AS p,
                  1 + (1000000000 * (k.lang_n + 2)) // (l.lang_total + 2 * l.v) AS q
           FROM totals g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c
             ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@register("op11_source_divergence", DIVERGENCE_SQL)
def op11_source_divergence(spark, sf_dir):
    """How far the term use of every source differs from its language's other sources, and its terms."""
    return source_divergence.audit(read_table(spark, sf_dir, "documents"), min_docs=10, top=10)


@register("op13_fingerprint")
def op13_fingerprint(spark, sf_dir):
    """Fingerprint of every document, held against its half-replaced text and the next document."""
    return fingerprint.compare_with_next(read_table(spark, sf_dir, "documents"))


def damaged(turns):
    """Conversations with a fifth of their rows damaged, by a checksum of ``conv_id:turn``: 0 drops a row,
    1 empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes it the user's. Nulls are one space."""
    filled = turns.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = filled.withColumn("kind", F.crc32(key.cast("binary")) % 20).filter("kind <> 0")
    rows = rows.withColumns({
        "text": F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))})
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy")


def _state(s: str, cost: str, letter: str) -> str:
    """SQL: a state (cost in 12 digits, then the audit) after one more edit; null stays null."""
    return f"(printf('%012d', CAST({s}[:12] AS BIGINT) + {cost}) || {s}[13:] || {letter})"


def _with_inserts(s0: str, s1: str, s2: str, s3: str) -> str:
    """SQL: the four phases' states, inserts after them included."""
    after_u = f"least({s2}, {_state(s0, '3', repr('I'))}, {_state(s1, '3', repr('I'))}, {_state(s3, '3', repr('I'))})"
    return f"{s0} AS s0, {s1} AS s1, {after_u} AS s2, least({s3}, {_state(after_u, '3', repr('I'))}) AS s3"


def _step() -> str:
    """SQL: the four phases' states after a turn of initial ``r.c``, which ``must`` go or costs ``e`` to keep."""
    gone = {k: _state(f"w.s{k}", "4", "'D'") for k in range(4)}
    to = {(k, x): "CASE WHEN NOT r.must THEN " + _state(f"w.s{k}", f"(r.e + CASE WHEN r.c = '{x}' THEN 0 ELSE 3 END)",
                                                        f"CASE WHEN r.c = '{x}' THEN 'K' ELSE 'R' END") + " END"
          for k, x in ((0, "u"), (1, "u"), (3, "u"), (2, "a"))}
    system = "CASE WHEN NOT r.must AND r.c = 's' THEN " + _state("w.s0", "r.e", "'K'") + " END"
    return (f"{gone[0]} AS t0, least({gone[1]}, {system}) AS t1, "
            f"least({gone[2]}, {to[0, 'u']}, {to[1, 'u']}, {to[3, 'u']}) AS t2, least({gone[3]}, {to[2, 'a']}) AS t3")


REPAIR_SQL = rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                        lambda x: CAST(unicode(x) AS BIGINT)) AS codes FROM conversations),
hashed AS (SELECT *, xor(4294967295, list_reduce(flatten(list_transform(codes, lambda x: [x, -1, -1, -1, -1, -1, -1, -1, -1])),
             lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END, CAST(4294967295 AS BIGINT))) % 20 AS k FROM src),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
                   CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM hashed, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) WHERE k <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged),
judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                          WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                          WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
                  lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS two FROM placed),
turns AS (SELECT *, role[1:1] AS c, fault IN ('b', 'd') AS must, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS e FROM judged),
ids AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
  SELECT conv_id, 0 AS i, repeat('0', 12) AS s0, CAST(NULL AS VARCHAR) AS s1, repeat('0', 11) || '3I' AS s2, repeat('0', 11) || '6II' AS s3 FROM ids
  UNION ALL
  SELECT conv_id, i, {_with_inserts('t0', 't1', 't2', 't3')} FROM (
    SELECT w.conv_id, w.i + 1 AS i, {_step()}
    FROM walk w JOIN turns r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1)),
best AS (SELECT conv_id, arg_max(least(s0, s3), i) AS s FROM walk GROUP BY conv_id),
audits AS (SELECT conv_id, CAST(s[:12] AS BIGINT) AS cost, s[13:] AS audit FROM best),
edits AS (SELECT conv_id, audit, p, audit[p:p] AS x FROM audits, unnest(range(1, length(audit) + 1)) u(p)),
numbered AS (SELECT *, count(*) FILTER (x <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i,
                    count(*) FILTER (x <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS place,
                    count(*) FILTER (x <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd FROM edits),
lines AS (SELECT n.conv_id, p, CASE WHEN x = 'K' THEN role WHEN (place + odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                               CASE WHEN x = 'I' THEN '' ELSE text END AS line
          FROM numbered n LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM n.conv_id AND t.i = n.i WHERE x <> 'D'),
written AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS body FROM lines GROUP BY conv_id),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
                count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM audits a LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN written w ON w.conv_id IS NOT DISTINCT FROM a.conv_id
"""


@register("op12_conversation_repair", REPAIR_SQL)
def op12_conversation_repair(spark, sf_dir):
    """Faults, cheapest repair and repaired text's checksum of every damaged conversation."""
    turns = read_table(spark, sf_dir, "conversations")
    hurt = damaged(turns)
    audits = freeze(conversation_repair.audit(hurt))
    digests = conversation_repair.repaired_digests(hurt, audits)
    found = audits.join(digests.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    ids = turns.select(F.col("conv_id").alias("id")).distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
