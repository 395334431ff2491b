"""The registered queries once more, in SQL for DuckDB.

Written from the rules and not from the Spark code: a word is the only run of
letters in a list of runs, a rank is a window over the decade, and so on.
"""

from __future__ import annotations

from pairsift.sources import corpus, stopwords

LETTERS = r"a-z\x{0590}-\x{05FF}"
DECIMALS = 4


def _quoted(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def _trimmed(text: str) -> str:
    return rf"regexp_replace({text}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def _tokens(text: str) -> str:
    return rf"string_split_regex({_trimmed(text)}, '[ \t\n\x0B\f\r]+')"


def _word(raw: str) -> str:
    runs = f"regexp_extract_all(lower({raw}), '[{LETTERS}]+')"
    return f"CASE WHEN len({runs}) = 1 AND length({runs}[1]) > 1 THEN {runs}[1] END"


def _whole(text: str, type_name: str) -> str:
    digits = _trimmed(text)
    return f"CASE WHEN regexp_full_match({digits}, '[+-]?[0-9]+') THEN TRY_CAST({digits} AS {type_name}) END"


def _stop_list() -> str:
    return ", ".join(map(_quoted, stopwords.stop_words()))


def _lines(table: str, id_column: str, text: str, prefix: str = "") -> list[str]:
    """CTEs ``uni`` and ``bi``: ngram, year, cnt of a table of texts."""
    year = f"(1900 + {id_column} % 12 * 10 + {id_column} % 7)::INT"
    return [
        f"{prefix}txt AS (SELECT {year} AS year, {_tokens(text)} AS toks FROM {table})",
        f"{prefix}uni AS (SELECT ngram, year, count(*) AS cnt FROM"
        f" (SELECT unnest(toks) AS ngram, year FROM {prefix}txt) WHERE ngram <> '' GROUP BY ALL)",
        f"{prefix}bi AS (SELECT p[1] || ' ' || p[2] AS ngram, year, count(*) AS cnt FROM"
        f" (SELECT unnest(list_zip(toks[1:len(toks)-1], toks[2:len(toks)])) AS p, year"
        f" FROM {prefix}txt WHERE len(toks) > 1) GROUP BY ALL)",
    ]


def _counts(prefix: str = "") -> list[str]:
    """CTEs from lines to counted words and pairs."""
    return [
        f"{prefix}uw AS (SELECT trunc(year / 10)::INT * 10 AS decade, {_word('ngram')} AS w, cnt"
        f" FROM {prefix}uni)",
        f"{prefix}words AS (SELECT * FROM {prefix}uw WHERE w IS NOT NULL)",
        f"{prefix}unigrams AS (SELECT decade, w, sum(cnt)::BIGINT AS c FROM {prefix}words GROUP BY ALL)",
        f"{prefix}totals AS (SELECT decade, sum(c)::BIGINT AS n FROM {prefix}unigrams GROUP BY ALL)",
        f"{prefix}bt AS (SELECT toks[1] AS t1, toks[2] AS t2, year, cnt FROM"
        f" (SELECT {_tokens('ngram')} AS toks, year, cnt FROM {prefix}bi) WHERE len(toks) = 2)",
        f"{prefix}bw AS (SELECT trunc(year / 10)::INT * 10 AS decade, {_word('t1')} AS w1,"
        f" {_word('t2')} AS w2, cnt FROM {prefix}bt)",
        f"{prefix}clean AS (SELECT * FROM {prefix}bw WHERE w1 IS NOT NULL AND w2 IS NOT NULL)",
        f"stop AS (SELECT unnest([{_stop_list()}]) AS w)",
        f"{prefix}kept AS (SELECT * FROM {prefix}clean"
        " WHERE w1 NOT IN (FROM stop) AND w2 NOT IN (FROM stop))",
        f"{prefix}pairs AS (SELECT decade, w1, w2, sum(cnt)::BIGINT AS c12 FROM {prefix}kept GROUP BY ALL)",
    ]


def _joined(unigrams: str = "unigrams", totals: str = "totals") -> str:
    return (
        "joined AS (SELECT b.decade, b.w1, b.w2, c12, coalesce(a1.c, 0) AS c1,"
        " coalesce(a2.c, 0) AS c2, n"
        f" FROM pairs b LEFT JOIN {unigrams} a1 ON (a1.decade, a1.w) = (b.decade, b.w1)"
        f" LEFT JOIN {unigrams} a2 ON (a2.decade, a2.w) = (b.decade, b.w2)"
        f" LEFT JOIN {totals} t ON t.decade = b.decade)"
    )


def _ratio(top: str, bottom: str) -> str:
    by_zero = f"CASE WHEN {top} > 0 THEN 'inf'::DOUBLE WHEN {top} < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END"
    return f"CASE WHEN {bottom} = 0 THEN {by_zero} ELSE ({top})::DOUBLE / ({bottom})::DOUBLE END"


def _logl(k: str, n: str, x: str) -> str:
    return f"({k}) * ln({x}) + (({n}) - ({k})) * ln(1.0::DOUBLE - {x})"


def _clamped(x: str) -> str:
    return (
        f"CASE WHEN isnan({x}) THEN {x} WHEN {x} <= 0 THEN 1e-15::DOUBLE"
        f" WHEN {x} >= 1 THEN 1.0::DOUBLE - 1e-15::DOUBLE ELSE {x} END"
    )


def _terms() -> list[str]:
    return [
        f"chances AS (SELECT *, {_ratio('c2', 'n')} AS r, {_ratio('c12', 'c1')} AS r1,"
        f" {_ratio('(c2 - c12)', '(n - c1)')} AS r2 FROM joined)",
        f"clamped AS (SELECT *, {_clamped('r')} AS x, {_clamped('r1')} AS x1,"
        f" {_clamped('r2')} AS x2 FROM chances)",
        f"terms AS (SELECT *, {_logl('c12', 'c1', 'x1')} AS a1, {_logl('c2 - c12', 'n - c1', 'x2')} AS a2,"
        f" {_logl('c12', 'c1', 'x')} AS b1, {_logl('c2 - c12', 'n - c1', 'x')} AS b2 FROM clamped)",
        f"scored AS (SELECT *, round(2.0::DOUBLE * ((a1 + a2) - (b1 + b2)), {DECIMALS}) + 0.0::DOUBLE"
        " AS score FROM terms)",
        "ranked AS (SELECT decade, row_number() OVER (PARTITION BY decade ORDER BY score DESC, w1, w2)"
        "::BIGINT AS rn, score, w1, w2 FROM scored)",
    ]


def _with(*parts: str | list[str], select: str) -> str:
    ctes: list[str] = []
    for part in parts:
        ctes += [part] if isinstance(part, str) else part
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _documents(select: str, *more: str) -> str:
    return _with(
        _lines("documents", "doc_id", "text"), _counts(), _joined(), _terms(), *more, select=select
    )


def _products() -> str:
    lines = [
        "sold AS (SELECT p_name, year(l_shipdate)::INT AS year, sum(l_quantity)::BIGINT AS cnt"
        " FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)",
        f"uni AS (SELECT unnest({_tokens('p_name')}) AS ngram, year, cnt FROM sold)",
        "bi AS (SELECT p_name AS ngram, year, cnt FROM sold)",
    ]
    return _with(lines, _counts(), _joined(), _terms(), select="SELECT * FROM ranked WHERE rn <= 100")


def _pages() -> str:
    return _with(
        _lines("pages", "page_id", "html"), _counts(), _joined(), _terms(),
        select="SELECT * FROM ranked WHERE rn <= 100",
    )


def _hebrew(select: str) -> str:
    def values(rows: list[tuple]) -> str:
        return ", ".join(f"({_quoted(ngram)}, {year}, {count})" for ngram, year, count in rows)

    text = f"translate(lower(text), '{corpus.LATIN}', '{corpus.HEBREW}')"
    return _with(
        _lines("documents", "doc_id", text, "d_"),
        f"uni AS (FROM d_uni UNION ALL VALUES {values(corpus.HEBREW_UNIGRAMS)})",
        f"bi AS (FROM d_bi UNION ALL VALUES {values(corpus.HEBREW_BIGRAMS)})",
        _counts(), _joined(), _terms(),
        select=select,
    )


def _token_edges() -> str:
    odd = ", ".join(map(_quoted, corpus.ODD_TOKENS))
    dressed = ", ".join(corpus.DRESSED)
    return _documents(
        f"SELECT raw, {_word('raw')} AS token FROM (SELECT DISTINCT raw FROM"
        f" (SELECT unnest([{dressed}]) AS raw FROM (SELECT DISTINCT ngram AS raw FROM uni)"
        f" UNION ALL SELECT unnest([{odd}])))"
    )


def _own_stopwords() -> str:
    return _documents(
        "SELECT decade, w1, w2, sum(cnt)::BIGINT AS c12 FROM clean"
        " WHERE w1 NOT IN (FROM own) AND w2 NOT IN (FROM own) GROUP BY ALL",
        "own AS (SELECT w FROM unigrams GROUP BY w ORDER BY sum(c) DESC, w LIMIT 50)",
    )


def _other_corpus() -> str:
    return _with(
        _lines("documents", "doc_id", "text"),
        _lines("conversations", "conv_id", "text", "s_"),
        [part for part in _counts() if not part.startswith(("uw", "words", "unigrams", "totals"))],
        [part for part in _counts("s_") if part.startswith(("s_uw", "s_words", "s_unigrams", "s_totals"))],
        _joined("s_unigrams", "s_totals"),
        _terms(),
        select="SELECT decade, w1, w2, c12, c1, c2, n, score FROM scored",
    )


def _rejects() -> str:
    mixed = (
        "mixed AS (SELECT ngram || chr(9) || year || chr(9) || cnt AS value FROM bi"
        " UNION ALL SELECT unnest(string_split(text, chr(10))) FROM documents"
        " UNION ALL SELECT concat_ws(chr(9), p_name, p_brand, p_size) FROM part"
        " UNION ALL SELECT concat_ws(chr(9), p_name, '1995', p_retailprice) FROM part"
        " UNION ALL SELECT concat_ws(chr(9), p_type, '1995', p_size) FROM part"
        " UNION ALL SELECT concat_ws(chr(9), o_orderpriority, ' 1995 ', ' +' || o_custkey) FROM orders)"
    )
    steps = [
        "fields AS (SELECT string_split(rtrim(value, chr(9)), chr(9)) AS f FROM mixed)",
        f"read AS (SELECT f, {_whole('f[2]', 'INT')} AS year, {_whole('f[3]', 'BIGINT')} AS cnt,"
        f" {_tokens('f[1]')} AS toks FROM fields)",
        f"tested AS (SELECT *, {_word('toks[1]')} AS w1, {_word('toks[2]')} AS w2 FROM read)",
        f"stop AS (SELECT unnest([{_stop_list()}]) AS w)",
        "reasons AS (SELECT CASE WHEN len(f) < 3 THEN 'fields' WHEN year IS NULL THEN 'year'"
        " WHEN len(toks) <> 2 THEN 'tokens' WHEN w1 IS NULL OR w2 IS NULL THEN 'word'"
        " WHEN w1 IN (FROM stop) OR w2 IN (FROM stop) THEN 'stopword'"
        " WHEN cnt IS NULL THEN 'count' ELSE 'accepted' END AS reason FROM tested)",
    ]
    return _with(
        _lines("documents", "doc_id", "text"), mixed, steps,
        select="SELECT reason, count(*) AS cnt FROM reasons WHERE reason <> 'accepted' GROUP BY ALL",
    )


def _funnel() -> str:
    def row(stage: str, rows_in: str, rows_out: str) -> str:
        return (
            f"SELECT '{stage}' AS stage, (SELECT count(*) FROM {rows_in}) AS rows_in,"
            f" (SELECT count(*) FROM {rows_out}) AS rows_out"
        )

    return _documents(
        " UNION ALL ".join(
            [
                row("bigram_lines", "bi", "kept"),
                row("unigram_lines", "uni", "words"),
                row("bigram_counts", "kept", "pairs"),
                row("unigram_counts", "words", "unigrams"),
                row("join_c1", "pairs", "joined"),
                row("join_c2", "joined", "joined"),
                row("score", "joined", "scored"),
                row("totals", "unigrams", "totals"),
                row("top", "scored", "(FROM ranked WHERE rn <= 100)"),
            ]
        )
    )


def _checked() -> str:
    """Result lines and their damaged forms, with what is wrong with each."""
    score = f"(score::DECIMAL(24, {DECIMALS}))"
    line = f"decade || chr(9) || {score} || chr(9) || w1 || ',' || w2"

    def wrong(problem: str, text: str) -> str:
        return (
            "SELECT NULL::INTEGER AS decade, NULL::DOUBLE AS score, NULL AS w1, NULL AS w2,"
            f" '{problem}' AS problem, {text} AS line FROM best"
        )

    return _documents(
        " UNION ALL ".join(
            [
                "SELECT decade, score, w1, w2, NULL AS problem, NULL AS line FROM best",
                wrong("fields", f"replace({line}, chr(9), ' ')"),
                wrong("decade", f"'  ' || {line}"),
                wrong("score", "decade || chr(9) || 'n/a' || chr(9) || w1 || ',' || w2"),
                wrong("pair", f"decade || chr(9) || {score} || chr(9) || w1 || ' ' || w2"),
                wrong("word", f"decade || chr(9) || {score} || chr(9) || w1 || '9' || w2 || ',' || w2"),
            ]
        ),
        "best AS (FROM ranked WHERE rn <= 100)",
    )


def _runs() -> str:
    return _documents(
        "SELECT w1, w2, min(first) AS first_decade, max(last) AS last_decade, sum(n)::BIGINT AS decades,"
        " string_agg(CASE WHEN last = (SELECT max(decade) FROM best) THEN first || '+'"
        " WHEN first = last THEN first::VARCHAR ELSE first || '-' || last END, ', ' ORDER BY first) AS runs"
        " FROM runs GROUP BY ALL",
        "best AS (FROM ranked WHERE rn <= 100)",
        # A run begins where the decade before is missing.
        "marked AS (SELECT *, CASE WHEN lag(decade) OVER (PARTITION BY w1, w2 ORDER BY decade) = decade - 10"
        " THEN 0 ELSE 1 END AS begins FROM best)",
        "numbered AS (SELECT *, sum(begins) OVER (PARTITION BY w1, w2 ORDER BY decade) AS run FROM marked)",
        "runs AS (SELECT w1, w2, run, min(decade) AS first, max(decade) AS last, count(*) AS n"
        " FROM numbered GROUP BY ALL)",
    )


def _stopword_counts() -> str:
    listed = " UNION ALL ".join(
        f"SELECT unnest([{', '.join(map(_quoted, words))}]) AS w, '{lang}' AS lang"
        for lang, words in (("en", stopwords.english()), ("he", stopwords.hebrew()))
    )
    return _documents(
        "SELECT l.w, l.lang, coalesce(sum(u.c), 0)::BIGINT AS c"
        f" FROM ({listed}) l LEFT JOIN unigrams u ON u.w = l.w GROUP BY ALL"
    )


def all_sql() -> dict[str, str]:
    def terms(name: str, sql: str) -> str:
        return f"round({sql}, {DECIMALS}) + 0.0::DOUBLE AS {name}"

    top = "FROM ranked WHERE rn <= 100"
    return {
        "ngram_parse_unigrams": _documents("SELECT ngram, year, cnt FROM uni"),
        "ngram_parse_bigrams": _documents("SELECT ngram, year, cnt FROM bi"),
        "decade_bucket": _documents(
            "SELECT trunc(year / 10)::INT * 10 AS decade, count(*) AS lines,"
            " sum(cnt)::BIGINT AS cnt FROM bi GROUP BY ALL"
        ),
        "bigram_tokens": _documents("SELECT t1, t2, year, cnt FROM bt"),
        "clean_token": _documents(
            f"SELECT raw, {_word('raw')} AS token FROM (SELECT DISTINCT ngram AS raw FROM uni)"
        ),
        "unigram_clean": _documents("SELECT decade, w, cnt FROM words"),
        "bigram_clean": _documents("SELECT decade, w1, w2, cnt FROM clean"),
        "stopwords_dim": _stopword_counts(),
        "bigram_stopword_filter": _documents("SELECT decade, w1, w2, cnt FROM kept"),
        "bigram_stopword_antijoin": _documents("SELECT decade, w1, w2, cnt FROM kept"),
        "bigram_counts": _documents("SELECT decade, w1, w2, c12 FROM pairs"),
        "bigram_counts_from_sequence": _documents("SELECT decade, w1, w2, c12 FROM pairs"),
        "bigram_counts_of_two_loads": _documents("SELECT decade, w1, w2, c12 FROM pairs"),
        "pairs_of_frequent_words": _documents(
            "SELECT decade, w1, w2, c12 FROM pairs WHERE w1 IN (FROM frequent)",
            "frequent AS (SELECT w1 FROM pairs GROUP BY w1 ORDER BY sum(c12) DESC, w1 LIMIT 10)",
        ),
        "bigram_counts_sorted": _documents("SELECT decade, w1, w2, c12 FROM pairs ORDER BY ALL"),
        "unigram_counts": _documents("SELECT decade, w, c FROM unigrams"),
        "decade_totals": _documents("SELECT decade, n FROM totals"),
        "join_c1": _documents("SELECT decade, w1, w2, c12, c1 FROM joined"),
        "join_c2": _documents("SELECT decade, w1, w2, c12, c1, c2 FROM joined"),
        "join_totals": _documents("SELECT decade, w1, w2, c12, c1, c2, n FROM joined"),
        "logl_terms": _documents(
            "SELECT decade, w1, w2, "
            + ", ".join(
                terms(name, sql)
                for name, sql in (
                    ("dep_with", "a1"),
                    ("dep_without", "a2"),
                    ("ind_with", "b1"),
                    ("ind_without", "b2"),
                )
            )
            + " FROM terms"
        ),
        "llr_score": _documents("SELECT decade, w1, w2, score FROM scored"),
        "llr_score_other_corpus": _other_corpus(),
        "rank_per_decade": _documents("SELECT * FROM ranked"),
        "topk_per_decade": _documents("SELECT * FROM ranked WHERE rn <= 10"),
        "topk_per_decade_5000": _documents("SELECT * FROM ranked WHERE rn <= 5000"),
        "collocations_top100": _documents(f"SELECT * {top}"),
        "collocations_from_text": _documents(f"SELECT * {top}"),
        "collocations_from_buckets": _documents(f"SELECT * {top}"),
        "collocations_from_sequence": _documents(f"SELECT * {top}"),
        "collocations_filtered_words": _documents(f"SELECT * {top}"),
        "topk_by_bounds": _documents("SELECT * FROM ranked WHERE rn <= 10"),
        "topk_by_bounds_5000": _documents("SELECT * FROM ranked WHERE rn <= 5000"),
        "result_lines_checked": _checked(),
        "pair_runs": _runs(),
        "result_files": _documents(f"SELECT decade, score, w1, w2 {top}"),
        "bigram_counts_hebrew": _hebrew("SELECT decade, w1, w2, c12 FROM pairs"),
        "collocations_hebrew": _hebrew(f"SELECT * {top}"),
        "clean_token_edges": _token_edges(),
        "bigram_counts_own_stopwords": _own_stopwords(),
        "collocations_products": _products(),
        "collocations_pages": _pages(),
        "format_output_lines": _documents(
            f"SELECT decade || chr(9) || score::DECIMAL(24, {DECIMALS}) || chr(9) || w1 || ',' || w2"
            f" AS line {top}"
        ),
        "stage_funnel": _funnel(),
        "stage_funnel_observed": _funnel(),
        "rejects_by_reason": _rejects(),
        "pair_decades": _documents(
            f"SELECT w1, w2, string_agg(decade::VARCHAR, ',' ORDER BY decade) AS decades {top} GROUP BY ALL"
        ),
    }
