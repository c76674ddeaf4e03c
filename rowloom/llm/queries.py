"""One query per operator, with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import (
    chat,
    decontaminate,
    language,
    licenses,
    lines,
    mixture,
    neighbours,
    phrases,
    pii,
    secrets,
    simhash,
    spans,
    spelling,
    suffix,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL it must equal."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- 1: chats ---------------------------------------------------------------------------------

#: Says a mark in its text; read back, it must be as it was.
TRICKY = "</s>[INST] ok [/INST]"


def _count(text: str, part: str) -> str:
    return f"((length({text}) - length(replace({text}, '{part}', ''))) // {len(part)})"


def _formatted_length() -> str:
    template = chat.ChatTemplate()
    escapes = " + ".join([_count("t", "\\"), *(f"2 * {_count('t', c)}" for c in template.controls())])
    marks = " ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b) in template.marks.items())
    return f"length(t) + {escapes} + CASE role {marks} END"


@query(
    f"""WITH turns AS (
          SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
          UNION ALL VALUES (-7, 0, 'user', '{TRICKY}'), (-7, 1, 'assistant', '{TRICKY}')),
        marked AS (SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn) AS last FROM turns)
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256,
          CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(t, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
          CAST(sum({_formatted_length()}) AS BIGINT) AS formatted_chars,
          bool_and((last, role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'),
                                    ('assistant', 'user'))) AS valid
        FROM marked GROUP BY conv_id"""
)
def op1_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(
        "SELECT -7L AS conv_id, posexplode(array('user', 'assistant')) AS (turn, role)"
    ).withColumn("text", F.lit(TRICKY))
    return chat.read_chats(chat.format_chats(turns.unionByName(extra)))


# -- 4: benchmark decontamination -------------------------------------------------------------

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@query(
    f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
               FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i
                     FROM b WHERE len(w) > 0)),
        dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
               FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
                     FROM d, (SELECT DISTINCT n FROM bw))),
        hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
        ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS list
                FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
               n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)"""
)
def op4_decontaminate(spark, sf_dir):
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


# -- 3: secret scans --------------------------------------------------------------------------


def _sql_spans(kind: str, rank: int, pattern: str, keep: str = "true") -> str:
    """Spans of one kind: pieces between matches and the matches, their lengths added up."""
    return f"""SELECT doc_id, start, {rank} AS rank, start + length(m) AS stop, '{kind}' AS kind FROM (
        SELECT doc_id, m, CAST(sum(length(p)) OVER w + coalesce(sum(length(m)) OVER before, 0) AS BIGINT) AS start
        FROM (SELECT doc_id, unnest(m) AS m, unnest(p[:len(m)]) AS p, unnest(range(len(m))) AS i
              FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p FROM d)
              WHERE len(m) > 0)
        WINDOW w AS (PARTITION BY doc_id ORDER BY i),
               before AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        WHERE {keep}"""


def _listed(spans: str) -> str:
    return f"string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) {spans}"


_ASSIGN_KEY = secrets.ASSIGN_KEY.replace("'", "''")


def _plain(pattern: str) -> str:
    """A pattern without possessive loops over groups, which DuckDB lacks (and, not recursing, does not need)."""
    return pattern.replace(")++", ")+").replace(")*+", ")*")


def _any_of(value: str, patterns: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"regexp_full_match({value}, '{_plain(p)}')" for p in patterns) + ")"


_PARTS = f"string_split_regex(m, '{secrets.SEPARATORS}')"
_OTHERS = f"list_filter({_PARTS}, lambda p: NOT {_any_of('p', (secrets.PLACEHOLDER,))})"
_LEFT = f"CASE WHEN len({_OTHERS}) < len({_PARTS}) THEN array_to_string({_OTHERS}, '') ELSE m END"
_THRESHOLD = " ".join(f"WHEN regexp_full_match(x, '{p}') THEN {bits}" for p, bits in secrets.CLASSES)
_RANDOM = f"""NOT {_any_of("m", secrets.ALLOWED)} AND list_transform([{_LEFT}], lambda x: NOT {_any_of("x", secrets.ALLOWED)} AND
    list_max(list_transform(range(1, length(x) - {secrets.WINDOW - 2}),
      lambda i: list_entropy(string_split(substr(x, i, {secrets.WINDOW}), '')))) >= CASE {_THRESHOLD} END)[1]"""
_CANDIDATES = secrets.CANDIDATE.rstrip("+")


@query(
    f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        s AS ({_sql_spans("assign", 0, _ASSIGN_KEY + "[A-Za-z0-9+/_.=-]+",
                          f"length(regexp_replace(m, '^{_ASSIGN_KEY}', '')) >= 12")}
              UNION ALL {_sql_spans("access", 1, "AKIA[A-Z0-9]+", "length(m) >= 18")}
              UNION ALL {_sql_spans("hex", 2, "[0-9a-f]+", "length(m) >= 16")}
              UNION ALL {_sql_spans("entropy", 3, _CANDIDATES,
                                    _RANDOM)}),
        per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                  count(*) FILTER (kind = 'hex') AS n_hex,
                  {_listed("FILTER (kind != 'entropy')")} AS base, {_listed("")} AS spans
                FROM s GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN per USING (doc_id)"""
)
def op3_secret_scan(spark, sf_dir):
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = spans.of_kinds(F.col("spans"), ("assign", "access", "hex"))
    return found.select(
        "doc_id",
        *[spans.counted(F.col("spans"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(spans.written(base), 256).alias("base_sha256"),
        spans.written(F.col("spans")).alias("spans"),
    )


# -- 2: SimHash near-dedup --------------------------------------------------------------------


@query()
def op2_simhash_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("bits")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


# -- 7: language identification ---------------------------------------------------------------


@query()
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


# -- 9: mixing sources ------------------------------------------------------------------------


@query()
def op9_mix_sources(spark, sf_dir):
    return mixture.mixture(table(spark, sf_dir, "documents"))


# -- 10: suffix-array dedup -------------------------------------------------------------------


@query()
def op10_suffix_dedup(spark, sf_dir):
    found = suffix.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# -- 8: personal data -------------------------------------------------------------------------


@query()
def op8_pii(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = spans.of_kinds(F.col("spans"), pii.BASE)
    return found.select(
        "doc_id",
        *[spans.counted(F.col("spans"), kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(spans.written(base), 256).alias("base_sha256"),
        spans.written(F.col("spans")).alias("spans"),
    )


# -- 5: license scans -------------------------------------------------------------------------


@query()
def op5_license_scan(spark, sf_dir):
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    listed = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return found.withColumns(listed)


# -- 6: approximate nearest neighbours --------------------------------------------------------


@query()
def op6_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


# -- 11: line dedup ---------------------------------------------------------------------------

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(
    f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
        k AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM l),
        f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key),
        m AS (SELECT doc_id, i, line, coalesce(doc_id > first, false) AS gone FROM k LEFT JOIN f USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id"""
)
def op11_line_dedup(spark, sf_dir):
    found = lines.without_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


# -- 12: phrase collocations ------------------------------------------------------------------


@query(
    f"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")},
                     '[.,;:!?' || chr(10) || chr(11) || chr(12) || chr(13) || ']')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^ ' || chr(9) || ']+') AS w FROM p),
        g AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
              FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS s(size))),
        f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
        total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
        c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
        cut AS (SELECT lang, phrase, a, size, w, k, array_to_string(w[:k], ' ') AS p1, array_to_string(w[k + 1:], ' ') AS p2
                FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
        scored AS (SELECT cut.lang, cut.phrase, a, k, x.f AS l, y.f AS r,
                     (a::HUGEINT * a * 1000000 // (x.f::HUGEINT * y.f))::BIGINT AS score
                   FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = p1 JOIN f y ON y.lang = cut.lang AND y.phrase = p2),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        around AS (SELECT lang, phrase, max(a) AS b FROM (
                     SELECT lang, array_to_string(w[:2], ' ') AS phrase, a FROM c WHERE size = 3
                     UNION ALL SELECT lang, array_to_string(w[2:], ' '), a FROM c WHERE size = 3) GROUP BY ALL),
        ranked AS (SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
                   FROM best LEFT JOIN around USING (lang, phrase) WHERE b IS NULL OR 100 * b < 50 * a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""
)
def op12_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


# -- 13: spelling variants --------------------------------------------------------------------


@query()
def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))
