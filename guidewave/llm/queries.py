"""Registered queries of the corpus operators; each reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import cut_lineage, shared_path
from . import conversations, decontaminate, language, licenses, merkle, mixing, pii, secrets, sharding, simhash, suffix_lm, warc, winnowing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORDS = r"list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


@query("op3_benchmark_decontamination", f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, k, w[i:i + k - 1] AS gram FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, k, w[i:i + k - 1] AS gram FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw)) WHERE i + k - 1 <= len(w)),
hits AS (SELECT doc_id, item_id, i, k FROM dw JOIN bw USING (k, gram)),
n AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN t ON d.doc_id = t.doc_id""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit()
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


@query("op4_histogram_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op5_simhash_near_duplicates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def held_out(modulus: int, rest: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest, F.lit(False))


@query("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), docs.where(~held_out(4, 2)))
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


@query("op10_soft_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixing_rates(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "tokens", *[F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(mixing.DOMAINS)], "rate", "copies")


@query("op9_suffix_tree_scores")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_lm.scored(table(spark, sf_dir, "documents"), ~held_out(5, 1))
    return found.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _found(k: int, rule: secrets.Rule) -> str:
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    length = lambda part: f"coalesce(list_sum(list_transform({part}, lambda x: length(x))), 0)"
    return f"""SELECT r, '{rule.kind}' AS kind, {k} AS place, CAST({length('gaps[1:i]')} + {length('whole[1:i - 1]')} AS BIGINT) AS s, length(whole[i]) AS n FROM
        (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM (SELECT r, regexp_split_to_array(t, {pattern}) AS gaps, regexp_extract_all(t, {pattern}) AS whole, regexp_extract_all(t, {pattern}, {rule.group}) AS held FROM d WHERE regexp_matches(t, {pattern})))
        WHERE length(held[i]) >= {rule.least}"""


_SECRET_SPANS = "coalesce(string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, place){}, '')"


@query("op2_secrets", f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
f AS ({' UNION ALL '.join(_found(k, rule) for k, rule in enumerate(secrets.RULES))})
SELECT any_value(doc_id) AS doc_id, {', '.join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE_RULES)},
       sha256({_SECRET_SPANS.format(f' FILTER (place < {len(secrets.BASE_RULES)})')}) AS base_sha256, {_SECRET_SPANS.format(' FILTER (kind IS NOT NULL)')} AS spans
FROM d LEFT JOIN f USING (r) GROUP BY r""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    base, every = tuple(r.kind for r in secrets.BASE_RULES), tuple(r.kind for r in secrets.RULES)
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return secrets.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *map(count, base), F.sha2(secrets.joined_spans(spans, base).cast("binary"), 256).alias("base_sha256"), secrets.joined_spans(spans, every).alias("spans"))


@query("op7_winnowing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compared(table(spark, sf_dir, "documents"))


_TEMPLATES = ", ".join(f"({k}, '{t.label}', '{t.words}', {str(t.base).lower()})" for k, t in enumerate(licenses.TEMPLATES))


@query("op6_licenses", f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
t AS (SELECT *, string_split(words, ' ') AS tw FROM (VALUES {_TEMPLATES}) AS v(template, label, words, base)),
tg AS (SELECT template, i - 1 AS place, tw[i:i + 1] AS gram FROM (SELECT template, tw, unnest(range(1, len(tw))) AS i FROM t)),
dg AS (SELECT r, i - 1 AS pos, w[i:i + 1] AS gram FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM d)),
v AS (SELECT r, template, pos - place AS diagonal, count(*) AS hits, min(place) AS least, max(place) AS most FROM dg JOIN tg USING (gram) GROUP BY ALL),
o AS (SELECT v.*, label, base, len(tw) - 1 AS n_grams, hits = len(tw) - 1 AS whole FROM v JOIN t USING (template)),
l AS (SELECT *, lag(diagonal) OVER z AS was, lag(most) OVER z AS upto, lag(whole) OVER z AS done FROM o WINDOW z AS (PARTITION BY r, template ORDER BY diagonal)),
g AS (SELECT *, sum(CASE WHEN coalesce(diagonal - was <= {licenses.DRIFT} AND least > upto AND NOT done AND NOT whole AND NOT base, false) THEN 0 ELSE 1 END) OVER (PARTITION BY r, template ORDER BY diagonal) AS part FROM l),
m AS (SELECT r, label, base, part, min(diagonal + least) AS first_word, sum(hits) / CAST(any_value(n_grams) AS DOUBLE) AS coverage FROM g GROUP BY r, template, label, base, part),
k AS (SELECT r, count(*) FILTER (base) AS n_base, min(first_word) FILTER (base) AS first_word, max(first_word) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score FROM m WHERE CASE WHEN base THEN coverage = 1 ELSE coverage >= {licenses.COVERED} END GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score FROM d LEFT JOIN k ON d.r = k.r""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first_word"])
    labels = lambda spans: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))))
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
                        labels(base).alias("base_labels"), labels(F.col("found")).alias("labels"), F.coalesce(F.array_max(F.transform("found", lambda s: s["coverage"])), F.lit(0.0)).alias("score"))


@query("op1_personal_data")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    place = F.create_map(*[x for k, kind in enumerate(pii.KINDS) for x in (F.lit(kind), F.lit(k))])

    def joined(spans):
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(place[s["kind"]].alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.concat_ws(",", F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))


def _written(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_written, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _crc32(value: str) -> str:
    """CRC-32 of an ASCII text as SQL, bit by bit over its bytes."""
    step = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({value}, ''), lambda c: ascii(c)::BIGINT)),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: {step})), 4294967295)"""


@query("op11_merkle_manifest", f"""
WITH RECURSIVE raw AS (SELECT *, {_leaf('n_chars')} AS leaf FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, lang, leaf, CASE WHEN coalesce({_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0, false) THEN {_leaf('n_chars + 1')} ELSE leaf END AS claimed,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM raw),
t(lang, level, place, digest, n) AS (SELECT lang, 0, place, leaf, n FROM d
    UNION ALL SELECT lang, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (max(n) + 1) // 2 FROM t WHERE n > 1 GROUP BY lang, level, place // 2),
s AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM t WHERE n = 1),
u(level, place, digest, n) AS (SELECT 0, place, subroot, n FROM s
    UNION ALL SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (max(n) + 1) // 2 FROM u WHERE n > 1 GROUP BY level, place // 2),
steps AS (
    SELECT r, 0 AS part, v.level, v.place % 2 AS side, x.digest FROM d JOIN t v ON v.lang IS NOT DISTINCT FROM d.lang AND v.place = d.place >> v.level AND v.n > 1
        LEFT JOIN t x ON x.lang IS NOT DISTINCT FROM v.lang AND x.level = v.level AND x.place = xor(v.place, 1)
    UNION ALL SELECT r, 1, v.level, v.place % 2, x.digest FROM d JOIN s ON s.lang IS NOT DISTINCT FROM d.lang JOIN u v ON v.place = s.place >> v.level AND v.n > 1
        LEFT JOIN u x ON x.level = v.level AND x.place = xor(v.place, 1)),
w AS (SELECT r, list(side || coalesce(digest, '') ORDER BY part, level) AS path, string_agg(coalesce(digest, ''), '' ORDER BY part, level) AS siblings FROM steps GROUP BY r),
f AS (SELECT doc_id, leaf, lang, coalesce(siblings, '') AS siblings,
        list_reduce(list_prepend(claimed, coalesce(path, [])), lambda x, y: sha256(CASE WHEN y[1] = '1' THEN y[2:] || x ELSE x || y[2:] END)) AS folded_root FROM d LEFT JOIN w USING (r))
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, folded_root, folded_root = root AS verified
FROM f JOIN s ON s.lang IS NOT DISTINCT FROM f.lang, (SELECT digest AS root FROM u WHERE n = 1)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = merkle.manifest(docs, docs["n_chars"] + F.when(divisible(docs["doc_id"], 7), 1).otherwise(0))
    found = found.withColumn("folded_root", merkle.folded(F.col("claimed"), F.col("witness")))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("witness")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def divisible(number: Column, by: int) -> Column:
    return F.coalesce(F.crc32(number.cast("string").cast("binary")) % by == 0, F.lit(False))


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` after the stated damage; nulls of role and text are one space."""
    said = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" "))
    k = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(k == 1, "").when(k == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    copies = F.explode(F.when(k == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.where(k != 0).select("conv_id", "turn", F.when(k == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


_TRIM = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: (role, must go, from, to, cost, letters): an edit of one row with the inserts before it
_EDITS = ", ".join(
    f"('{role}', {str(gone).lower()}, {i}, {j}, {step[0]}, '{conversations.flat(step[1])}')"
    for role in conversations.ROLES for gone in (False, True)
    for i, row in enumerate(conversations.terminal(role, "blank" if gone else "none")) for j, step in enumerate(row) if step is not None)
_ENDS = ", ".join(f"({i}, {j}, {step[0]}, '{conversations.flat(step[1])}')" for i, row in enumerate(conversations.inserts()) for j, step in enumerate(row) if step is not None)


@query("op12_conversation_repair", f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k FROM conversations),
g AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE k WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) - 1 AS place, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, right(rtrim(text, {_TRIM}), 1) AS last FROM g),
f AS (SELECT *, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'x' END AS initial, CASE WHEN last = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault FROM o),
h AS (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair FROM f),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM h GROUP BY conv_id),
e(initial, gone, i, j, cost, letters) AS (VALUES {_EDITS}),
z(i, j, cost, letters) AS (VALUES {_ENDS}),
p(conv_id, place, state, best) AS (SELECT conv_id, 0, 0, {{'cost': 0, 'audit': ''}} FROM c
    UNION ALL SELECT p.conv_id, p.place + 1, e.j, min({{'cost': p.best.cost + e.cost + CASE WHEN f.fault = 'truncated' AND NOT contains(e.letters, 'D') THEN {conversations.TRUNCATED_COST} ELSE 0 END, 'audit': p.best.audit || e.letters}})
        FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.place = p.place JOIN e ON e.initial = f.initial AND e.gone = (f.fault IN ('blank', 'duplicate')) AND e.i = p.state GROUP BY p.conv_id, p.place, e.j),
b AS (SELECT p.conv_id, min({{'cost': p.best.cost + z.cost, 'audit': p.best.audit || z.letters}}) AS best FROM p JOIN c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND p.place = c.n JOIN z ON z.i = p.state WHERE z.j IN (0, 3) GROUP BY p.conv_id),
l AS (SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS spot FROM b),
m AS (SELECT conv_id, spot, audit[spot] AS letter, count(*) FILTER (audit[spot] <> 'I') OVER (PARTITION BY conv_id ORDER BY spot) - 1 AS place, count(*) FILTER (audit[spot] <> 'D') OVER (PARTITION BY conv_id ORDER BY spot) AS kept FROM l),
q AS (SELECT m.*, f.role, f.text, f.initial, bool_or(kept = 1 AND letter = 'K' AND f.initial = 's') OVER (PARTITION BY m.conv_id) AS led FROM m LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.place = m.place AND m.letter <> 'I' WHERE letter <> 'D'),
r AS (SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role ELSE CASE WHEN (kept - led::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY spot)) AS repaired FROM q GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
       coalesce(best.audit, '') AS audit, coalesce(repaired, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM a.conv_id""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = table(spark, sf_dir, "conversations")
    rows = damaged(original)
    found = cut_lineage(conversations.repairs(rows))
    digests = conversations.repaired_digests(rows, found.select("key", "audit"))
    every = original.groupBy("conv_id").agg(F.count("*").alias("rows"))
    every = every.select("conv_id", conversations.conversation_key(F.col("conv_id")).alias("key"))
    whole = every.join(found.drop("conv_id"), "key", "left").join(digests, "key", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@query("op13_warc_archive", f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
g AS (SELECT page_id, payload_bytes, sha256(html) AS payload_digest, first_value(page_id) OVER w AS first_page, row_number() OVER w > 1 AND payload_bytes >= {warc.REVISIT_BYTES} AS revisit
      FROM p WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN revisit THEN first_page END AS refers_to FROM g""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, path = table(spark, sf_dir, "pages"), shared_path(spark, "warc")
    warc.write_archive(pages, path)
    kind = pages.schema["page_id"].dataType
    found = warc.read_archive(spark, path, payloads=False)
    return found.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_page").cast(kind).alias("refers_to"))
