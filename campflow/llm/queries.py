"""One registered query per operator, over whole tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campflow.llm import (
    decontaminate, langid, licences, mixing, phrases, pseudonyms, quality, repeats, simhash, templates, tokens, tries, urls,
)
from campflow.llm.common import read_table, stage
from campflow.session import work_dir


#: The key of the registered query only; a real job takes its own from where it keeps secrets.
PSEUDONYM_KEY = "registered query"


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeated_spans(read_table(spark, sf_dir, "documents"))
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select("doc_id", "n_rows", "first_ids", "spans", size.alias("repeated_bytes"))


def as_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: a folder per source, 700 ids and 70 ids; every seventh is a notice file, and
    every seventh of these lies one folder higher."""
    number, source = F.col("doc_id"), F.coalesce("source", F.lit("unknown"))
    upper = F.concat_ws("/", source, F.floor(number / 700))
    lower = F.concat_ws("/", upper, F.floor(number / 70))
    path = (
        F.when(number % 49 == 0, F.concat(upper, F.lit("/LICENSE-"), number))
        .when(number % 7 == 0, F.concat(lower, F.lit("/LICENSE-"), number))
        .otherwise(F.concat(lower, F.lit("/"), number, F.lit(".txt")))
    )
    return docs.select("doc_id", path.alias("path"), "text")


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(as_files(read_table(spark, sf_dir, "documents")))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def tokenizer_file() -> str:
    """The vocabulary file of the queries, where it is installed on each machine."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def token_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the ids of ``docs``, read the files back, and describe what they hold."""
    folder = work_dir(spark, "tokens")
    tokens.write_tokens(docs, folder, tokenizer_file())
    return tokens.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark, read_table(spark, sf_dir, "documents"))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = templates.without_templates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("chars_left"),
                      F.md5("text").alias("text_md5"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judged(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select("doc_id", *counts, "base_failed", "kept", F.array_join("broken", ",").alias("broken"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(read_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonyms.pseudonymised(read_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    return out.select("doc_id", "n_values", "text")


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return groups.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


#: Fixed: the rules of the query, and the words that put a host on the list that it makes of the pages.
URL_RULES = {"net/": urls.BLOCK, "example.net/en/": urls.ALLOW, "example.com/de/": urls.BLOCK, "org/fr/": urls.ALLOW}
LISTED_WORDS = ("bets", "betting", "casino", "gambling", "jackpot", "loans", "pills", "poker", "porn", "slots", "viagra", "xxx")


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(list(URL_RULES.items()), "entry string, verdict string")
    lists = [urls.write_list(rules, work_dir(spark, "url_rules")),
             urls.write_list(urls.listed_hosts(pages, LISTED_WORDS), work_dir(spark, "url_hosts"))]
    judged = urls.judged(pages, lists)
    return judged.select("page_id", "host", "path", F.when(F.col("place") == 0, F.col("entry")).alias("rule"), "verdict")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the one whose id is the next lower multiple of 20.

    ``turns`` as :func:`tries.numbered` counts them. Of a conversation c, h = crc32(c) mod 4 turns go, and as many of the
    other one's first turns come before the rest (all, if it has fewer). Returns the turns and the ids of all.
    """
    ids = turns.select("conv_id").distinct().select(
        "conv_id", (F.crc32(F.col("conv_id").cast("string")) % 4).alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base")
    )
    heads = turns.filter("place <= 3").withColumnRenamed("conv_id", "base")
    lent = ids.filter("h > 0").join(heads, "base").filter("place <= h").select("conv_id", "place", "key", "words")
    found = heads.groupBy("base").agg(F.max("place").alias("found"))
    ids = ids.join(found, "base", "left").select("conv_id", "h", F.least("h", F.coalesce("found", F.lit(0))).alias("taken"))
    rest = turns.join(ids, "conv_id").filter("place > h")
    rest = rest.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "key", "words")
    return lent.unionByName(rest), ids.select("conv_id")


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stage(tries.numbered(read_table(spark, sf_dir, "conversations")).drop("role", "text"), "turns")
    nodes, members = tries.prefix_nodes(*rebuilt(turns))
    nodes = nodes.join(tries.member_digests(members), "node", "left")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


PHRASE_SUPPORT, PHRASES_OF_A_LANGUAGE = 30, 2000


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(read_table(spark, sf_dir, "documents"), PHRASE_SUPPORT)
    best = phrases.best_phrases(found, PHRASES_OF_A_LANGUAGE)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_repeats": _op1,
    "op2_licence_scan": _op2,
    "op3_benchmark_leaks": _op3,
    "op4_token_files": _op4,
    "op5_line_templates": _op5,
    "op6_quality_rules": _op6,
    "op7_language_crf": _op7,
    "op8_pseudonyms": _op8,
    "op9_mix_sources": _op9,
    "op10_simhash_groups": _op10,
    "op11_url_filter": _op11,
    "op12_conversation_trie": _op12,
    "op13_phrases": _op13,
}

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


def _quality_sql() -> str:
    """The counts, the exact binomial tests in sequence, and the verdicts. (Risk and level are those of the module.)"""
    rules, level = quality.RULES, quality.LEVEL
    share = {
        "symbols": "n_symbols / greatest(word_chars, 1)", "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
        "capitals": "n_capitals / greatest(n_letters, 1)", "word_length": "word_chars / greatest(n_words, 1)",
    }
    grid = ", ".join(f"('{rule}', {i}, CAST({c} AS DOUBLE))" for rule, cuts in rules.items() for i, c in enumerate(cuts))
    shares = " UNION ALL ".join(f"SELECT doc_id, lang, '{rule}' AS rule, {share[rule]} AS share FROM counted" for rule in rules)
    risk = f"CAST({quality.RISK / len(rules)!r} AS DOUBLE)"
    return rf"""
WITH base AS (SELECT doc_id, lang, coalesce(text, '') AS text, {_WORDS.replace("text", "coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, k, w[k : k + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM base)),
covered AS (SELECT doc_id, count(DISTINCT k + j) AS n FROM (
  SELECT doc_id, k FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1), range(5) r(j) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS d FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM base)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counted AS (SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(lines.n - lines.d, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines,
  length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) AS n_letters,
  length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) AS n_capitals
  FROM base LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
shares AS ({shares}),
grid(rule, nth, cutoff) AS (VALUES {grid}),
marks AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
risks AS (SELECT lang, rule, nth, cutoff, count(*) FILTER (quality = 1) AS n,
  count(*) FILTER (quality = 1 AND share > cutoff) AS k, count(*) FILTER (quality != 1 AND share > cutoff) AS bad
  FROM shares JOIN marks USING (doc_id) JOIN grid USING (rule) GROUP BY ALL),
tested AS (SELECT *, CASE WHEN n = 0 OR k >= n THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
   exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk}) + (n - i) * ln(1 - {risk})))) END AS p,
  (SELECT count(DISTINCT coalesce(lang, '<none>')) FROM risks) * {len(rules)} AS tests FROM risks),
admitted AS (SELECT * FROM tested QUALIFY bool_and(p <= {level} / tests) OVER (PARTITION BY lang, rule ORDER BY nth)),
picked AS (SELECT lang, rule, cutoff FROM admitted WHERE bad - {quality.COST} * k > 0
  QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY bad - {quality.COST} * k DESC, nth) = 1),
broken AS (SELECT doc_id, string_agg(rule, ',' ORDER BY list_position({list(rules)}, rule)) AS broken
  FROM shares s JOIN picked p USING (rule) WHERE s.lang IS NOT DISTINCT FROM p.lang AND share > cutoff GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
 n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, coalesce(broken, '') AS broken,
 NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND broken IS NULL AS kept
FROM counted LEFT JOIN broken USING (doc_id)"""


def _templates_sql() -> str:
    t = templates
    return rf"""
WITH lines AS (SELECT doc_id, place_of, line, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'),
   lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS m
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place_of
   FROM documents)),
own AS (SELECT DISTINCT doc_id, m, list_prepend(CAST(len(m) AS VARCHAR), m[1 : {t.LEADING}]) AS leaf FROM lines WHERE len(m) > 0),
leaves AS (SELECT leaf FROM own GROUP BY leaf HAVING count(DISTINCT doc_id) >= {t.MIN_DOCS}),
same AS (SELECT leaf, m, count(*) AS n FROM own JOIN leaves USING (leaf) GROUP BY ALL),
placed AS (SELECT leaf, m, n, unnest(m) AS token, generate_subscripts(m, 1) AS place FROM same),
support AS (SELECT leaf, place, token, sum(n) AS support FROM placed WHERE token != '<*>' GROUP BY ALL HAVING sum(n) >= {t.MIN_DOCS}),
ranked AS (SELECT p.leaf, p.m, list(p.place || ' ' || p.token ORDER BY support DESC, p.place) AS fixed
  FROM placed p JOIN support s ON p.leaf = s.leaf AND p.place = s.place AND p.token = s.token GROUP BY p.leaf, p.m),
chains AS (SELECT leaf, m, fixed[1 : nth] AS template FROM (SELECT *, unnest(range(1, len(fixed) + 1)) AS nth FROM ranked)
  WHERE nth / len(m) >= {t.MIN_FIXED}),
recurring AS (SELECT leaf, template FROM own JOIN chains USING (leaf, m) GROUP BY leaf, template
  HAVING count(DISTINCT doc_id) >= {t.MIN_DOCS}),
gone AS (SELECT DISTINCT m FROM chains JOIN recurring USING (leaf, template)),
marked AS (SELECT doc_id, place_of, line, len(m) > 0 AS worded, m IN (SELECT m FROM gone) AS dropped FROM lines),
left_over AS (SELECT doc_id, count(*) FILTER (worded) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY place_of) FILTER (NOT dropped), '') AS text FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
 CAST(length(l.text) AS BIGINT) AS chars_left, md5(l.text) AS text_md5 FROM documents d LEFT JOIN left_over l USING (doc_id)"""


def _urls_sql() -> str:
    rules = ", ".join(f"('{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}', '{verdict}')" for rule, verdict in URL_RULES.items())
    part = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"
    return rf"""
WITH rules(rule, rule_host, rule_path, verdict) AS (VALUES {rules}),
parts AS (SELECT row_number() OVER () AS row, page_id,
  translate(regexp_extract(coalesce(url, ''), {part}, 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), {part}, 2) AS path FROM pages),
best AS (SELECT row, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY row)
SELECT page_id, host, path, rule, coalesce(verdict,
  CASE WHEN regexp_matches(host, '(^|[.-])({"|".join(LISTED_WORDS)})([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN best USING (row)"""


#: CRC-32 (reflected polynomial) of a text of ASCII characters, bit by bit.
_CRC32_SQL = """(xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
  range(0, 8 * length(t)), lambda i: CAST(((ascii(substring(t, i // 8 + 1, 1)) >> (i % 8)) & 1) AS BIGINT))),
  lambda c, b: xor(c >> 1, CASE WHEN xor(c & 1, b) = 1 THEN 3988292384 ELSE 0 END))))"""

_TRIE_SQL = rf"""
WITH own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
  {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t FROM conversations WHERE conv_id IS NOT NULL),
whole AS (SELECT conv_id, list(t ORDER BY place) AS ts FROM own GROUP BY conv_id),
heads AS (SELECT conv_id, ts, {_CRC32_SQL.replace("(t)", "(CAST(conv_id AS VARCHAR))").replace("substring(t,", "substring(CAST(conv_id AS VARCHAR),")} % 4 AS h FROM whole),
made AS (SELECT c.conv_id, list_concat(coalesce(b.ts, [])[1 : c.h], c.ts[c.h + 1 :]) AS ts
  FROM heads c LEFT JOIN whole b ON b.conv_id = c.conv_id - c.conv_id % 20),
steps AS (SELECT conv_id, unnest(range(0, len(ts) + 1)) AS depth, ts FROM made),
nodes AS (SELECT ts[1 : depth] AS way, depth, min(conv_id) AS conv_id, count(*) AS n,
  string_agg(CASE WHEN depth = len(ts) THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends,
  coalesce(len(regexp_extract_all(ts[depth].text, '[^ 	-
]+')), 0) AS words
  FROM steps GROUP BY ts[1 : depth], depth, coalesce(len(regexp_extract_all(ts[depth].text, '[^ 	-
]+')), 0)),
named AS (SELECT *, row_number() OVER () AS id FROM nodes),
kids AS (SELECT p.id, count(*) AS n_children FROM named p JOIN named k ON k.depth = p.depth + 1 AND k.way[1 : p.depth] = p.way GROUP BY p.id),
lines AS (SELECT id, unnest(range(0, depth + 1)) AS up, way, n, words FROM named),
sums AS (SELECT a.id, count(*) FILTER (k.id IS NULL) AS n_leaves, sum((l.n - 1) * l.words) AS saved_tokens
  FROM lines l JOIN named a ON a.depth = l.up AND a.way = l.way[1 : l.up] LEFT JOIN kids k ON k.id = l.id GROUP BY a.id)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n AS n_convs,
 coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(c.ends, '')) AS ends_sha256
FROM named c LEFT JOIN named p ON p.depth = c.depth - 1 AND p.way = c.way[1 : p.depth]
 LEFT JOIN kids ON kids.id = c.id JOIN sums ON sums.id = c.id"""


def _phrases_sql(support: int = PHRASE_SUPPORT, first: int = PHRASES_OF_A_LANGUAGE) -> str:
    return rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')), '[^ 	]+') AS w FROM documents),
grams AS (SELECT lang, k, w[i : i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
  FROM pieces, (VALUES (1), (2), (3), (4)) ks(k) WHERE len(w) >= k)),
counts AS (SELECT lang, k, g, count(*) AS a FROM grams GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM counts WHERE a >= {support}),
cuts AS (SELECT lang, k, g, a, unnest(range(1, k)) AS cut FROM often WHERE k > 1),
scored AS (SELECT c.lang, c.k, c.g, c.a, cut, l.a AS l, r.a AS r,
   CAST((CAST(2000000 AS HUGEINT) * c.a) // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score
  FROM cuts c JOIN often l ON l.lang = c.lang AND l.g = c.g[1 : cut] JOIN often r ON r.lang = c.lang AND r.g = c.g[cut + 1 :]),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
inner_ones AS (SELECT lang, a, g[i : i + size - 1] AS g FROM (SELECT lang, k, g, a, size, unnest(range(1, k - size + 2)) AS i
  FROM (SELECT lang, k, g, a, unnest(range(2, k)) AS size FROM often WHERE k > 2))),
longer AS (SELECT lang, g, max(a) AS b FROM inner_ones GROUP BY ALL),
kept AS (SELECT o.*, array_to_string(o.g, ' ') AS phrase FROM lowest o LEFT JOIN longer x ON x.lang = o.lang AND x.g = o.g
  WHERE x.b IS NULL OR CAST(100 AS HUGEINT) * x.b < CAST(80 AS HUGEINT) * o.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN sizes USING (lang) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {first}"""


ORACLES: dict[str, str] = {
    "op11_url_filter": _urls_sql(),
    "op12_conversation_trie": _TRIE_SQL,
    "op13_phrases": _phrases_sql(),
    "op5_line_templates": _templates_sql(),
    "op6_quality_rules": _quality_sql(),
    # all items against all documents, without the search
    "op3_benchmark_leaks": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM d)),
iss AS (SELECT DISTINCT item_id, array_to_string(w[k : k + 4], ' ') AS shingle
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS k FROM i)),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM iss GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_found, count(*) / n_shingles AS containment
FROM ds JOIN iss USING (shingle) JOIN sizes USING (item_id) GROUP BY doc_id, item_id, n_shingles
HAVING count(*) / n_shingles >= 0.8""",
    "op9_mix_sources": f"""
WITH sized AS (SELECT doc_id, source, CAST(coalesce(len({_WORDS}), 0) AS BIGINT) AS size,
  md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'text ' || text, '')) AS draw FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight,
  2 * source_size AS cap FROM totals),
levels AS (SELECT w.*, (SELECT sum(least(o.cap, w.cap * o.weight / w.weight)) FROM weighed o) AS filled,
  (SELECT 1.5 * sum(o.source_size) FROM weighed o) AS budget FROM weighed w),
-- at a source's own level all sources together take at least the budget: it stays below its cap
split AS (SELECT *, filled < budget AS clamped FROM levels),
rest AS (SELECT CAST(3 * sum(source_size) - 2 * sum(CASE WHEN clamped THEN cap ELSE 0 END) AS BIGINT) AS words,
  CAST(sum(CASE WHEN clamped THEN 0 ELSE weight END) AS BIGINT) AS weight FROM split),
targets AS (SELECT source, source_size, CASE WHEN clamped THEN CAST(cap AS DOUBLE)
  ELSE CAST(rest.words * split.weight AS DOUBLE) / CAST(rest.weight * 2 AS DOUBLE) END AS target FROM split, rest),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM targets),
draws AS (SELECT source, draw, sum(size) AS size FROM sized GROUP BY ALL),
placed AS (SELECT source, draw, size, sum(size) OVER (PARTITION BY source ORDER BY draw) - size AS before FROM draws)
SELECT doc_id, s.size, source_size, target, CAST(s.size * (whole + CASE WHEN target - whole * source_size > 0
  AND before + p.size / 2 <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken,
 CAST(whole + CASE WHEN target - whole * source_size > 0
  AND before + p.size / 2 <= target - whole * source_size THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
 JOIN placed p ON p.source IS NOT DISTINCT FROM s.source AND p.draw = s.draw""",
}
