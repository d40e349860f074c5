"""The corpus operators as queries over the driver tables, and SQL to check them."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm import chat_format, language_id, secret_scan, url_filter
from lodeworks.llm.alignment import align
from lodeworks.llm.common import shared_folder, staged, table
from lodeworks.llm.decontamination import contamination
from lodeworks.llm.minhash import near_duplicates
from lodeworks.llm.packing import pack_documents
from lodeworks.llm.pii import replace_personal_data
from lodeworks.llm.repeats import remove_repeats
from lodeworks.llm.resampling import resample
from lodeworks.llm.token_files import read_token_files, token_file_path, write_token_files
from lodeworks.llm.topk import quantized, top_k


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    kept_out = language_id.held_out(F.col("doc_id"))
    model = language_id.train(documents.where(~kept_out).select("doc_id", "text", "lang"))
    rows = documents.select("doc_id", kept_out.alias("held_out"), "text")
    # The text is all that a prediction sees besides the model.
    return language_id.predict(rows, model).select(
        "doc_id", "held_out", "lang_pred", "score", "bits", "rejected"
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two deliveries of whole sources through one ledger: of the second only texts that the
    # first did not hold are scanned.
    ledger = f"{shared_folder(spark)}/secret-ledger-{uuid4().hex}"
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    later = F.pmod(F.xxhash64("source"), F.lit(2)) == 1
    first, second = (
        secret_scan.digests(secret_scan.scan_history(documents.where(part).drop("source"), ledger))
        for part in (~later, later)
    )
    return first.unionByName(second)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048
    )
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=100)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    spoof = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", spoof), (-7, 1, "assistant", spoof)], rows.schema)
    turns = rows.unionByName(added).select(
        "conv_id", "turn", "role", chat_format.text_part(F.col("text")).alias("parts")
    )
    return chat_format.digests(staged(chat_format.format_conversations(turns), "chats"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A deployment gives a secret key; a fixed one makes this query repeatable.
    return replace_personal_data(table(spark, sf_dir, "documents"), key="surrogates")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_file_path(shared_folder(spark))
    write_token_files(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json")
    )
    return read_token_files(spark, path)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10
    )


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantized(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256)
    return top_k(vectors.where("id % 50 = 0"), vectors, 5)


#: Host, path and verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Pages and documents are numbered alike: a page's outcome is the label of its number.
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        F.greatest(F.col("quality") == 0, F.col("toxic") == 1).alias("bad"),
    )
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), outcomes, rules).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_secrets": op2_secrets,
    "op3_packing": op3_packing,
    "op4_repeats": op4_repeats,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_chat": op6_chat,
    "op7_pii": op7_pii,
    "op8_token_files": op8_token_files,
    "op9_decontamination": op9_decontamination,
    "op10_top_k": op10_top_k,
    "op11_url_filter": op11_url_filter,
    "op12_resampling": op12_resampling,
    "op13_alignment": op13_alignment,
}

_ASCII_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"



def _secret_matches() -> str:
    """SQL for one row per match of every rule."""
    return " UNION ALL ".join(
        f"""SELECT row, {number} AS kind_no, '{rule.kind}' AS kind, '{rule.kind}' IN
            ('assign', 'access', 'hex') AS base, {rule.least} AS least,
            regexp_extract_all(text, $${rule.pattern}$$) AS m,
            regexp_extract_all(text, $${rule.pattern}$$, {rule.group}) AS v,
            regexp_split_to_array(text, $${rule.pattern}$$) AS gaps FROM d"""
        for number, rule in enumerate(secret_scan.RULES)
    )


def _chat_escape(text: str) -> str:
    return f"replace(replace({text}, '&', '&amp;'), '<', '&lt;')"


def _shrunk_level(name: str, key: str, source: str, parent: str, on: str) -> str:
    """SQL for one level of priors: ``name`` has ``mean`` and ``strength`` for its groups."""
    return f"""
        {name}_in AS (
            SELECT c.*, p.mean AS prior FROM {source} AS c JOIN {parent} AS p ON {on}
        ), {name}_k AS (
            SELECT CASE WHEN room IS NULL OR room = 0 THEN 10.0
                        WHEN excess / room <= 1.0 / 1001 THEN 1000.0
                        ELSE greatest(1.0, room / excess - 1) END AS strength
            FROM (SELECT sum((x - n * prior) ** 2 - n * prior * (1 - prior)) AS excess,
                         sum((n - 1) * n * prior * (1 - prior)) AS room FROM {name}_in)
        ), {name} AS (
            SELECT {key}, n, strength, (x + prior * strength) / (n + strength) AS mean
            FROM {name}_in, {name}_k
        )"""


_SUFFIXES = ", ".join(f"'{x}'" for x in url_filter.SUFFIXES)
_URL_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_FEATURES = """
    SELECT row, w[i : i + n - 1] AS gram, n FROM {words}, (SELECT unnest([1, 2]) AS n),
           unnest(range(1, len(w) - n + 2)) AS t(i)"""

ORACLE: dict[str, str] = {
    "op2_secrets": f"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents
        ), m AS ({_secret_matches()}), f AS (
            SELECT row, kind_no, kind, base,
                   list_sum(list_transform(gaps[1 : i], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0) AS s,
                   length(m[i]) AS n
            FROM m, unnest(range(1, len(m) + 1)) AS t(i) WHERE length(v[i]) >= least
        ), g AS (
            SELECT row, count(*) FILTER (kind = 'assign') AS n_assign,
                   count(*) FILTER (kind = 'access') AS n_access,
                   count(*) FILTER (kind = 'hex') AS n_hex,
                   string_agg(concat(kind, ':', s::BIGINT, ':', s::BIGINT + n), ',' ORDER BY s, kind_no)
                       FILTER (base) AS base,
                   string_agg(concat(kind, ':', s::BIGINT, ':', s::BIGINT + n), ',' ORDER BY s, kind_no)
                       AS spans
            FROM f GROUP BY row
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
               coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
               coalesce(spans, '') AS spans
        FROM d LEFT JOIN g USING (row)
    """,
    # Bytes as pairs of hex digits, as DuckDB cuts no slices of blobs.
    "op4_repeats": """
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS row, hex(encode(coalesce(text, ''))) AS h
            FROM documents
        ), w AS (
            SELECT row, doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS k
            FROM d, unnest(range(0, length(h) // 2 - 99)) AS t(i)
        ), f AS (
            SELECT row, i, min((doc_id, i)) OVER (PARTITION BY k) < (doc_id, i) AS late FROM w
        ), gone AS (
            SELECT DISTINCT row, i + j AS b FROM f, unnest(range(0, 100)) AS t(j) WHERE late
        ), n AS (
            SELECT row, count(*) AS n_removed, count(*) FILTER (b - 1 <> before) AS n_spans
            FROM (SELECT row, b, coalesce(lag(b) OVER (PARTITION BY row ORDER BY b), -9) AS before FROM gone)
            GROUP BY row
        ), rest AS (
            SELECT d.row, string_agg(substr(h, 2 * i + 1, 2), '' ORDER BY i) AS h
            FROM d SEMI JOIN n USING (row), unnest(range(0, length(h) // 2)) AS t(i)
            ANTI JOIN gone ON gone.row = d.row AND gone.b = i GROUP BY d.row
        )
        SELECT doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
               coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(CASE WHEN n.row IS NULL THEN d.h ELSE coalesce(rest.h, '') END)) AS kept_sha256
        FROM d LEFT JOIN n USING (row) LEFT JOIN rest USING (row)
    """,
    "op5_near_duplicates": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, row_number() OVER () AS row,
                   regexp_extract_all({_ASCII_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT row, w[i : i + least(3, len(w)) - 1] AS shingle
            FROM d, unnest(range(1, greatest(len(w) - 3, 0) + 2)) AS t(i) WHERE len(w) > 0
        ), n AS (SELECT row, count(*) AS n FROM s GROUP BY row),
        shared AS (
            SELECT a.row AS x, b.row AS y, count(*) AS common
            FROM s a JOIN s b USING (shingle) WHERE a.row < b.row GROUP BY a.row, b.row
        ), link AS (
            SELECT x, y FROM shared JOIN n a ON x = a.row JOIN n b ON y = b.row
            WHERE 100 * common >= 85 * (a.n + b.n - common)
        ), edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
        reach(row, other) AS (
            SELECT row, row FROM d UNION SELECT reach.row, y FROM reach JOIN edge ON other = x
        ), component AS (
            SELECT reach.row, min(d.doc_id) AS component_id
            FROM reach JOIN d ON reach.other = d.row GROUP BY reach.row
        )
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id,
               doc_id = component_id AS kept
        FROM d JOIN component USING (row) LEFT JOIN n USING (row)
    """,
    "op6_chat": f"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text))
                   AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                   FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(23 + length({_chat_escape("role")}) + length({_chat_escape("text")}))::BIGINT
                   AS formatted_chars
        FROM t GROUP BY conv_id
    """,
    "op9_decontamination": f"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS row,
                   regexp_extract_all({_ASCII_LOWER}, '{_TERM}') AS w FROM documents
        ), b AS (
            SELECT item_id::VARCHAR AS item, regexp_extract_all({_ASCII_LOWER}, '{_TERM}') AS w
            FROM benchmark
        ), phrase AS (
            SELECT DISTINCT item, least(10, len(w)) AS n, w[i : i + least(10, len(w)) - 1] AS p
            FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0
        ), place AS (
            SELECT row, i, n, w[i : i + n - 1] AS p
            FROM d, (SELECT DISTINCT n FROM phrase) AS s, unnest(range(1, len(w) - n + 2)) AS t(i)
        ), found AS (
            SELECT place.row, i, n, item FROM place JOIN phrase USING (n, p)
        ), hits AS (
            SELECT row, count(DISTINCT pos) AS n_hit
            FROM (SELECT row, unnest(range(i, i + n)) AS pos FROM found) GROUP BY row
        ), items AS (
            SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT row, item FROM found WHERE item IS NOT NULL) GROUP BY row
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits USING (row) LEFT JOIN items USING (row)
    """,
    "op10_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x)::DOUBLE) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_dot_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_url_filter": f"""
        WITH u AS (
            SELECT page_id, row_number() OVER () AS row,
                   CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), p AS (
            SELECT page_id, row, translate(regexp_extract(rest, '^[^/?#]*'),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u
        ), outcome AS (
            SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
            FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)
            GROUP BY doc_id
        ), bare AS (
            SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS x,
                   regexp_replace(host, '^[^@]*@|:[0-9]*$', '', 'g') AS name
            FROM p LEFT JOIN outcome ON page_id = doc_id GROUP BY host
        ), parts AS (
            SELECT *, string_split(name, '.') AS labels,
                   CASE WHEN len(string_split(name, '.')) > 2 AND array_to_string(string_split(name, '.')[-2:], '.') IN ({_SUFFIXES})
                        THEN 2 ELSE 1 END AS width FROM bare
        ), h AS (
            SELECT host, n, x,
                   CASE WHEN whole THEN name ELSE array_to_string(labels[-width:], '.') END AS suffix,
                   CASE WHEN whole THEN name ELSE array_to_string(labels[-width - 1:], '.') END AS domain
            FROM (SELECT *, len(labels) <= width OR regexp_full_match(name, '[0-9]+([.][0-9]+){{3}}') AS whole FROM parts)
        ), d AS (
            SELECT domain, suffix, sum(n) AS n, sum(x) AS x FROM h GROUP BY ALL
        ), s AS (SELECT suffix, sum(n) AS n, sum(x) AS x FROM d GROUP BY ALL),
        root AS (SELECT (sum(x) + 1.0) / (sum(n) + 2) AS mean FROM h),
        {_shrunk_level("by_suffix", "suffix", "s", "root", "true")},
        {_shrunk_level("by_domain", "domain, suffix", "d", "by_suffix", "c.suffix = p.suffix")},
        {_shrunk_level("by_host", "host", "h", "by_domain", "c.domain = p.domain")},
        reputation AS (
            SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (n + strength + 1)) AS least FROM by_host
        ), rules AS (SELECT * FROM (VALUES {_URL_RULES}) AS r(rule_host, rule_path, rule_verdict)),
        fits AS (
            SELECT row, arg_min(concat(rule_host, rule_path), order_key) AS rule,
                   arg_min(rule_verdict, order_key) AS rule_verdict
            FROM (
                SELECT row, rule_host, rule_path, rule_verdict,
                       concat(lpad((9999 - length(concat(rule_host, rule_path)))::VARCHAR, 4, '0'), rule_verdict) AS order_key
                FROM p JOIN rules ON (host = rule_host OR ends_with(host, concat('.', rule_host)))
                                 AND starts_with(path, rule_path)
            ) GROUP BY row
        )
        SELECT page_id, p.host, path, rule,
               coalesce(rule_verdict, CASE WHEN least > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
        FROM p LEFT JOIN fits USING (row) JOIN reputation ON p.host = reputation.host
    """,
    "op12_resampling": f"""
        WITH RECURSIVE bits(i, c, k) AS (
            SELECT i, i, 0 FROM range(0, 256) AS t(i)
            UNION ALL
            SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
        ), crc AS (SELECT i, c FROM bits WHERE k = 8),
        d AS (
            SELECT doc_id, row_number() OVER () AS row, regexp_extract_all({_ASCII_LOWER}, '{_TERM}') AS w
            FROM documents
        ), b AS (
            SELECT -row_number() OVER () AS row, regexp_extract_all({_ASCII_LOWER}, '{_TERM}') AS w FROM benchmark
        ), f AS (
            SELECT row, array_to_string(gram, ' ') AS feature, count(*) AS times
            FROM ({_FEATURES.format(words="d")} UNION ALL {_FEATURES.format(words="b")}) GROUP BY ALL
        ), hashed(feature, h, register) AS (
            SELECT feature, hex(encode(feature)), 4294967295 FROM (SELECT DISTINCT feature FROM f)
            UNION ALL
            SELECT feature, substr(h, 3), xor(register >> 8, c)
            FROM hashed JOIN crc ON i = xor(register & 255, ('0x' || substr(h, 1, 2))::BIGINT) WHERE h <> ''
        ), placed AS (
            SELECT row, times, xor(register, 4294967295) % 10000 AS bucket
            FROM f JOIN hashed USING (feature) WHERE h = ''
        ), buckets AS (
            SELECT bucket, coalesce(sum(times) FILTER (row > 0), 0) AS s, coalesce(sum(times) FILTER (row < 0), 0) AS t
            FROM placed GROUP BY bucket
        ), gain AS (
            SELECT bucket, floor(1000 * ln((buckets.t + 1)::DOUBLE * (total.s + 10000)::DOUBLE
                       / ((buckets.s + 1)::DOUBLE * (total.t + 10000)::DOUBLE)))::BIGINT AS gain
            FROM buckets, (SELECT sum(s) AS s, sum(t) AS t FROM buckets) AS total
        ), weight AS (
            SELECT row, sum(times)::BIGINT AS n_features, sum(times * gain)::BIGINT AS total
            FROM placed JOIN gain USING (bucket) GROUP BY row
        ), scored AS (
            SELECT row, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
                   coalesce(floor(total::DOUBLE / n_features), 0)::BIGINT AS weight,
                   ('0x' || substr(sha256(concat('7:', doc_id)), 1, 8))::BIGINT AS h
            FROM d LEFT JOIN weight USING (row)
        ), told AS (
            SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM scored
        ), ranked AS (
            SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, row) AS rank,
                   25 * count(*) OVER () // 100 AS drawn FROM told WHERE n_words >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= drawn THEN rank END AS rank
        FROM told LEFT JOIN ranked USING (row)
    """,
}
