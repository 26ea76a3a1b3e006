"""The operators over the given tables, by query name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import chat_windows, digests
from .common import table
from .decontamination import contaminations
from .html import extract_text
from .language import identify_languages
from .minhash import fingerprint_documents
from .mixing import mix
from .phrases import collocations
from .prefixes import prefix_trie
from .scoring import score_documents
from .secrets import scan_secrets
from .sharding import shard_documents
from .simhash import near_duplicates
from .urls import filter_urls


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates for secrets in all documents, with the forest's verdict."""
    return scan_secrets(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found inside documents, up to a few edits."""
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document by word counts and by the attention model."""
    return score_documents(table(spark, sf_dir, "documents"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, of an edited text of it, and their likeness."""
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    return filter_urls(table(spark, sf_dir, "pages"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    return shard_documents(table(spark, sf_dir, "documents"), 40)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return identify_languages(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of the sources by weight takes of every document."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words belong together."""
    return collocations(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix that conversations share, with what lies below it."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, as read back from their formatted windows."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-7).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return digests(chat_windows(rows.union(odd)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_secret_scan,
        op3_decontamination,
        op4_lm_scoring,
        op5_document_fingerprints,
        op6_url_filters,
        op7_sharding,
        op8_html_extraction,
        op9_language_id,
        op10_mixing,
        op11_phrase_collocations,
        op12_prefix_trie,
        op13_chat_formatting,
    )
}
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _host(url: str) -> str:
    return f"coalesce({_LOWER.format(f"regexp_extract({url}, '^.*?://([^/?#]*)', 1, 's')")}, '')"


def _path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '')"


def _address(url: str) -> str:
    part = lambda i: f"regexp_extract({url}, '^([^:/?#]*)://([^/?#]*)([^#]*)', {i}, 's')"
    return (
        f"CASE WHEN regexp_matches({url}, '^[^:/?#]*://') THEN {_LOWER.format(part(1))} || '://' ||"
        f" {_LOWER.format(part(2))} || CASE WHEN {part(3)} = '' THEN '/' ELSE {part(3)} END END"
    )


# Rules, then the aliases of each page: redirects and canonical links in its html, followed to all that they reach.
_URL_FILTERS = f"""
WITH RECURSIVE rules(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), tags AS (
  SELECT url, regexp_extract(bare, '<link\\b[^>]*\\brel\\s*=\\s*["'']?\\s*canonical\\b[^>]*>', 0, 'is') AS link,
    regexp_extract(bare, '<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?\\s*refresh\\b[^>]*>', 0, 'is') AS meta
  FROM (SELECT url, regexp_replace(html, '<!--.*?(?:-->|$)', '', 'gs') AS bare FROM pages)
), said AS (
  SELECT url, trim(regexp_replace(link, '&amp;', '&', 'gi')) AS link FROM (
    SELECT url, unnest([
      regexp_extract(link, '\\bhref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 1, 'is')
      || regexp_extract(link, '\\bhref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 2, 'is')
      || regexp_extract(link, '\\bhref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 3, 'is'),
      regexp_extract(meta, '\\burl\\s*=\\s*[''"]?\\s*([^''"\\s>]+)', 1, 'is')]) AS link
    FROM tags)
), targets AS (
  SELECT url, CASE
    WHEN regexp_matches(link, '^https?://', 'i') THEN link
    WHEN starts_with(link, '//') THEN regexp_extract(url, '^([^:/?#]*)://', 1) || ':' || link
    WHEN starts_with(link, '/') THEN regexp_extract(url, '^([^:/?#]*://[^/?#]*)', 1, 's') || link
    WHEN starts_with(link, '?') THEN regexp_extract(url, '^([^?#]*)', 1, 's') || link
    WHEN starts_with(link, '#') OR regexp_matches(link, '^[a-z][a-z0-9+.\\-]*:', 'i') THEN NULL
    WHEN {_path("url")} = '' THEN regexp_extract(url, '^([^:/?#]*://[^/?#]*)', 1, 's') || '/' || link
    ELSE regexp_extract(regexp_extract(url, '^([^?#]*)', 1, 's'), '^(.*/)', 1, 's') || link END AS target
  FROM said WHERE link <> ''
), edges AS (
  SELECT {_address("url")} AS a, {_address("target")} AS b FROM targets
), both_ways AS (
  SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b
), reached(node, other) AS (
  SELECT a, a FROM both_ways UNION SELECT r.node, e.b FROM reached r JOIN both_ways e ON e.a = r.other
), urls AS (
  SELECT {_host("url")} AS host, {_path("url")} AS path FROM pages UNION SELECT {_host("other")}, {_path("other")} FROM reached
), best AS (
  SELECT host, path, arg_max(rule_host || rule_path, weight) AS rule, arg_max(verdict, weight) AS verdict
  FROM (SELECT *, 2 * length(rule_host || rule_path) + CAST(verdict = 'allow' AS INT) AS weight FROM urls
    JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
  GROUP BY host, path
), aliases AS (
  SELECT node, bool_or(verdict = 'allow') AS allowed, bool_or(verdict = 'block') AS blocked
  FROM reached JOIN best ON host = {_host("other")} AND path = {_path("other")} GROUP BY node
)
SELECT page_id, p.host, p.path, best.rule,
  coalesce(best.verdict, CASE WHEN blocked AND NOT allowed THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT page_id, {_host("url")} AS host, {_path("url")} AS path, {_address("url")} AS node FROM pages) p
LEFT JOIN best ON best.host = p.host AND best.path = p.path LEFT JOIN aliases ON aliases.node = p.node
"""

# Every phrase of 1 to 4 words is counted; candidates, cuts and contained phrases follow from the counts.
_COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
), sizes AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), counts AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM places, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
  SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM counts WHERE k > 1
), scored AS (
  SELECT c.lang, c.phrase, c.a, cut, f.a AS l, r.a AS r, (2000000 * CAST(c.a AS HUGEINT)) // (f.a + r.a) AS score FROM cuts c
  JOIN counts f ON f.lang = c.lang AND f.phrase = array_to_string(w[1:cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')
), worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_phrases AS (
  SELECT lang, phrase, max(longer) AS longer FROM (
    SELECT lang, a AS longer, array_to_string(string_split(phrase, ' ')[i:i + s - 1], ' ') AS phrase
    FROM counts, (VALUES (2), (3)) AS lengths(s), (VALUES (1), (2), (3)) AS places(i) WHERE s < k AND i + s - 1 <= k)
  GROUP BY ALL
), ranked AS (
  SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, encode(w.phrase)) AS rank, w.phrase, a, l, r, score
  FROM worst w LEFT JOIN inner_phrases i ON i.lang = w.lang AND i.phrase = w.phrase
  WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

# A CRC-32 by its bits: a byte is taken in (non-negative), then eight shifts (-1).
_CRC32 = (
    "xor(list_reduce([4294967295] || flatten(list_transform(range(1, len({0}) + 1),"
    " lambda i: [ascii({0}[i]), -1, -1, -1, -1, -1, -1, -1, -1])), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)"
    " WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"
)
# A prefix is the list of its turns' digests, as text; the root's is empty.
_PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id AS c, key, x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) - 1 AS i
  FROM (SELECT conv_id, turn, coalesce(text, '') AS x,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key
    FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT c, {_CRC32.format("CAST(c AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
  SELECT n.c, 0 AS part, b.i, b.key, b.x FROM convs n JOIN turns b ON b.c = n.c - n.c % 5 AND b.i < n.h
  UNION ALL SELECT t.c, 1, t.i, t.key, t.x FROM turns t JOIN convs n ON t.c = n.c AND t.i >= n.h
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d FROM rebuilt
), prefixes AS (
  SELECT c, d, strlen(x) AS bytes, string_agg(key, ',') OVER (PARTITION BY c ORDER BY d) AS p FROM numbered
  UNION ALL SELECT c, 0, 0, '' FROM convs
), nodes AS (
  SELECT d, p, left(p, greatest(65 * (d - 1) - 1, 0)) AS parent, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes
  FROM prefixes GROUP BY d, p
), children AS (
  SELECT d - 1 AS d, parent AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), counted AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.d = n.d AND k.p = n.p
), below AS (
  SELECT a.d, a.p, sum(CAST(y.n_children = 0 AS BIGINT)) AS n_leaves, sum((y.n_convs - 1) * y.bytes) AS saved_tokens
  FROM counted y JOIN prefixes a ON a.c = y.conv_id AND a.d <= y.d GROUP BY a.d, a.p
), ends AS (
  SELECT d, p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends_sha256
  FROM (SELECT *, max(d) OVER (PARTITION BY c) AS last FROM prefixes) WHERE d = last GROUP BY d, p
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM counted n JOIN below b ON b.d = n.d AND b.p = n.p LEFT JOIN ends e ON e.d = n.d AND e.p = n.p
LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.parent AND n.d > 0
"""

ORACLES: dict[str, str] = {
    "op6_url_filters": _URL_FILTERS,
    "op11_phrase_collocations": _COLLOCATIONS,
    "op12_prefix_trie": _PREFIX_TRIE,
}
