"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm import bloom_lm, chat_repair, decontaminate, exact_search, fertility, fuzzy_lines, host_boilerplate, manifest, mixing, ranked_search, simhash_docs, substring_dedup, url_rules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(_table(spark, sf_dir, "conversations"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats_digest(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(_table(spark, sf_dir, "documents"))


def op5_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality(_table(spark, sf_dir, "documents"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_rules.RULES, "rule string, verdict string")
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), rules)


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_boilerplate.main_text(_table(spark, sf_dir, "pages"))


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.line_report(_table(spark, sf_dir, "documents"))


def op9_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_documents(_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_docs.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return manifest.audited(_table(spark, sf_dir, "documents"), {"text": F.translate("text", _UPPER, _LOWER)}, tampered)


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.top_products(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_chat_repair": op1_chat_repair,
    "op2_decontaminate": op2_decontaminate,
    "op3_substrings": op3_substrings,
    "op4_mixing": op4_mixing,
    "op5_fertility": op5_fertility,
    "op6_url_rules": op6_url_rules,
    "op7_main_text": op7_main_text,
    "op8_fuzzy_lines": op8_fuzzy_lines,
    "op9_bloom_lm": op9_bloom_lm,
    "op10_simhash": op10_simhash,
    "op11_ranked_search": op11_ranked_search,
    "op12_manifest": op12_manifest,
    "op13_exact_topk": op13_exact_topk,
}

_PLAIN = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_SPACED = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

_HASHED = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_HASHED.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _climb(name: str, rounds: int) -> str:
    """CTEs that take the nodes `<name>0` (g, pos, n, digest) up: level k + 1 from level k, as long as a g has more than one node."""
    return ", ".join(f"""
        {name}{k + 1} AS (
            SELECT g, pos // 8 AS pos, (any_value(n) + 7) // 8 AS n,
                CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
            FROM {name}{k} GROUP BY g, pos // 8
        )""" for k in range(rounds))


def _fold(name: str, nodes: str, rounds: int) -> str:
    """CTEs that take the rows `<name>0` (row, g, pos, folded, proof) through those levels, beside their siblings."""
    return ", ".join(f"""
        {name}{k + 1} AS (
            SELECT f.row, any_value(f.g) AS g, any_value(f.pos) // 8 AS pos,
                CASE WHEN any_value(n) = 1 THEN any_value(folded) ELSE sha256(string_agg(CASE WHEN s.pos = f.pos THEN folded ELSE digest END, '' ORDER BY s.pos)) END AS folded,
                any_value(proof) || coalesce(string_agg(digest, '' ORDER BY s.pos) FILTER (s.pos <> f.pos), '') AS proof
            FROM {name}{k} f JOIN {nodes}{k} s ON s.g = f.g AND s.pos // 8 = f.pos // 8 GROUP BY f.row
        )""" for k in range(rounds))


ORACLES = {
    "op11_ranked_search": f"""
        WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_PLAIN}) AS term FROM documents) GROUP BY doc_id, term),
        sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
        totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        asked AS (SELECT DISTINCT item_id, unnest({_PLAIN}) AS term FROM benchmark),
        scored AS (
            SELECT item_id, doc_id, sum(
                floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)))
            )::BIGINT AS score
            FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN sizes USING (doc_id), totals GROUP BY item_id, doc_id
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 50
    """,
    # crc32 is spelt out: a table of 256 remainders, made by rule, and one step for each digit.
    "op12_manifest": f"""
        WITH remainders AS (
            SELECT list(list_reduce(list_concat([n], range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
            FROM range(256) r(n)
        ),
        d AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, '-') AS g, {_leaf("text")} AS leaf,
                CASE WHEN xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(doc_id::VARCHAR, '.'), lambda x: ascii(x)::BIGINT)),
                    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0
                THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} ELSE {_leaf("text")} END AS changed
            FROM documents, remainders
        ),
        a0 AS (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n, leaf AS digest, row, changed, doc_id FROM d),
        {_climb("a", 9)},
        b0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n, digest, g AS member FROM a9),
        {_climb("b", 3)},
        f0 AS (SELECT row, g, pos, changed AS folded, '' AS proof FROM a0),
        {_fold("f", "a", 9)},
        h0 AS (SELECT row, '' AS g, b0.pos, folded, proof FROM f9 JOIN b0 ON member = f9.g),
        {_fold("h", "b", 3)}
        SELECT a0.doc_id, a0.digest AS leaf, b0.digest AS subroot, b3.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = b3.digest AS verified
        FROM a0 JOIN b0 ON member = a0.g JOIN h3 USING (row), b3
    """,
    "op3_substrings": f"""
        WITH d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
        windows AS (
            SELECT doc_id, k, array_to_string(w[k:k + 19], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS k FROM d)
        ),
        later AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY s ORDER BY doc_id, k) AS r FROM windows) WHERE r > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS p FROM later),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
        kept AS (
            SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS listed
            FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
        )
        SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(listed, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op2_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
        i AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
        item_windows AS (
            SELECT DISTINCT item_id, array_to_string(w[k:k + 9], ' ') AS s, least(len(w), 10) AS n
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
        ),
        sizes AS (SELECT DISTINCT n FROM item_windows),
        doc_windows AS (
            SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS s
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)
        ),
        found AS (SELECT doc_id, k, n, item_id FROM doc_windows JOIN item_windows USING (s, n)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM found) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
        )
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op13_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q
            FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )
        SELECT a.vec_id AS query_id, row_number() OVER best::INTEGER AS rank, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
        WINDOW best AS (PARTITION BY a.vec_id ORDER BY list_inner_product(a.q, b.q) DESC, b.vec_id)
        QUALIFY rank <= 20
    """,
    # The given pages hold no canonical links or refreshes, so spellings of one address are all the
    # aliases there are; tests cover the links.
    "op6_url_rules": f"""
        WITH p AS (
            SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
                coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
                regexp_replace(regexp_replace(coalesce(regexp_extract(url, '://[^?#]*\\?([^#]*)', 1), ''), '(?:^|&)utm_[^&]*', '', 'g'), '^&', '') AS query
            FROM pages
        ),
        rules AS (
            SELECT unnest([{", ".join(f"'{r}'" for r, _ in url_rules.RULES)}]) AS rule, unnest([{", ".join(f"'{v}'" for _, v in url_rules.RULES)}]) AS verdict
        ),
        fits AS (
            SELECT page_id, rule, verdict FROM p, (SELECT *, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS s FROM rules)
            WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)
            QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1
        ),
        judged AS (SELECT p.*, rule, verdict, host || regexp_replace(path, '/$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS address
            FROM p LEFT JOIN fits USING (page_id))
        SELECT page_id, host, path, rule,
            coalesce(verdict, CASE WHEN bool_or(verdict = 'block') OVER (PARTITION BY address) THEN 'block' ELSE 'allow' END) AS verdict
        FROM judged
    """,
}
