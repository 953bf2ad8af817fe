"""SQL counterparts of the registered queries, for DuckDB on the same tables.

Written from the definitions, by other means than the Spark side wherever there are
any: lists of words instead of whole-text patterns, a dense grid of days by
tickers instead of neighbours sent to each other, plain global row numbers instead
of hash-prefix histograms.
"""

from __future__ import annotations

from catalog import standins as s
from catalog.rules import INTERACTION_TREE, PRINTED_DEPTH
from postpulse.operators.ngrams import DOMAIN_STOP_WORDS

WORDS = 100
PER_CLASS = 30

# The features' names and order, and what each target's model sees.
META_FEATURES = (
    "num_words", "num_unique_words", "num_chars", "num_punctuations", "num_words_upper",
    "num_words_title", "mean_word_len", "num_special_char", "num_numerics", "num_uppercase",
    "num_lowercase",
)
SEEN = {
    "price_change": (
        "comment_num", "retweet_num", "like_num", *META_FEATURES, "polarity", "isExplicit", "typo",
    ),
    "interaction_level": ("price_diff", *META_FEATURES, "polarity", "isExplicit", "typo"),
    "sentiment": (
        "comment_num", "retweet_num", "like_num", "price_diff", *META_FEATURES, "isExplicit", "typo",
    ),
}
TARGETS = tuple(SEEN)


def feature_columns(target: str, words: int) -> list[str]:
    return [*SEEN[target], *[f"w_{i:03d}" for i in range(1, words + 1)]]


# English stop words.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what
which who whom this that these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for
with about against between into through during before after above below to from up
down in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so than too
very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd
you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't
won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's
let's ought that's there's what's when's where's who's why's would
""".split()


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


SPACE = r"[\t-\r\x1c-\x1f\x85\p{Z}]+"
STOP = listed(sorted({*ENGLISH_STOP_WORDS, *DOMAIN_STOP_WORDS}))
# The capital form of the sharp s is two letters.
UPPER = "replace(replace(upper(text), 'ß', 'SS'), 'ẞ', 'SS')"
CLEANED = "!\"#%&'()*+,-./:;<=>?@[\\]^_`{|}~–"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{SPACE}'), lambda w: w <> '')"


def squeezed(x: str) -> str:
    return f"array_to_string({words(x)}, ' ')"


def cleaned(x: str) -> str:
    return squeezed(f"translate({x}, {text(CLEANED)}, {text(' ' * len(CLEANED))})")


def word_tokens(x: str) -> str:
    return rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+')"


def vocabulary_tokens(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def letters(x: str) -> str:
    return f"trim(regexp_replace(lower(regexp_replace({x}, '[^a-zA-Z]', ' ', 'g')), ' +', ' ', 'g'))"


def review_words(x: str) -> str:
    kept = rf"lower(regexp_replace({x}, '[^a-zA-Z0-9\t-\r\x1c-\x1f\x85\p{{Z}}]', '', 'g'))"
    return f"list_filter({words(kept)}, lambda w: NOT list_contains({STOP}, w))"


_N = "len(list_filter(words, lambda w: {}))"
META = {
    "num_words": "len(words)",
    "num_unique_words": "len(list_distinct(words))",
    "num_chars": "length(raw)",
    "num_punctuations": r"len(regexp_extract_all(raw, '[!-/:-@\[-`{-~]'))",
    "num_words_upper": _N.format(
        r"regexp_matches(w, '\p{Lu}') AND NOT regexp_matches(w, '[\p{Ll}\p{Lt}]')"
    ),
    "num_words_title": _N.format(
        r"regexp_matches(w, '^[^\p{Lu}\p{Ll}\p{Lt}]*([\p{Lu}\p{Lt}]\p{Ll}*([^\p{Lu}\p{Ll}\p{Lt}]+|$))+$')"
    ),
    "mean_word_len": "list_sum(list_transform(words, lambda w: length(w)))::DOUBLE / nullif(len(words), 0)",
    "num_special_char": "len(regexp_extract_all(raw, '[^a-zA-Z0-9 ]'))",
    "num_numerics": "len(regexp_extract_all(raw, '[\\p{Nd}²³¹⁰⁴-⁹₀-₉]'))",
    "num_uppercase": _N.format(
        r"regexp_matches(w, '\p{Lu}') AND NOT regexp_matches(w, '[\p{Ll}\p{Lt}]')"
    ),
    "num_lowercase": _N.format(
        r"regexp_matches(w, '\p{Ll}') AND NOT regexp_matches(w, '[\p{Lu}\p{Lt}]')"
    ),
}


def level(x: str) -> str:
    return (
        f"CASE WHEN {x} > 11 THEN 'high' WHEN {x} > 2 AND {x} <= 11 THEN 'medium' "
        f"WHEN {x} > 0 AND {x} <= 3 THEN 'low' WHEN {x} = 0 THEN 'none' ELSE '0' END"
    )


def weights(source: str) -> str:
    return f"""SELECT avg(comment_num) AS comment_mean, avg(retweet_num) AS retweet_mean,
        avg(like_num) AS like_mean,
        avg(like_num) / nullif(avg(comment_num), 0) AS likes_to_comments,
        avg(like_num) / nullif(avg(retweet_num), 0) AS likes_to_retweets
      FROM {source} WHERE comment_num > 0 OR retweet_num > 0 OR like_num > 0"""


COMBINED = "(comment_num * likes_to_comments + retweet_num * likes_to_retweets + like_num)"
SENTIMENT = (
    "CASE WHEN polarity <= -0.5 THEN 'negative' WHEN polarity < 0.5 THEN 'neutral' "
    "WHEN polarity >= 0.5 THEN 'positive' ELSE '0' END"
)


def polarity_ctes(source: str) -> str:
    """`polarity` (tweet_id, polarity) of the cleaned texts in `source`."""
    entries = ", ".join(
        f"({text(t)}, {'NULL' if p is None else p}::DOUBLE, {'NULL' if i is None else i}::DOUBLE, {n})"
        for t, p, i, n in s.LEXICON
    )
    return f"""
    lexicon(term, polarity, intensity, negator) AS (VALUES {entries}),
    spoken AS (SELECT tweet_id, toks[i] AS w, i FROM (
        SELECT tweet_id, toks, unnest(generate_series(1, len(toks))) AS i FROM (
          SELECT tweet_id, {word_tokens('lower(body)')} AS toks FROM {source}))),
    placed AS (SELECT tweet_id, w, lag(w) OVER x AS w1, lag(w, 2) OVER x AS w2
      FROM spoken WINDOW x AS (PARTITION BY tweet_id ORDER BY i)),
    valued AS (SELECT tweet_id, least(1.0, greatest(-1.0, a.polarity * coalesce(b.intensity, 1.0)
          * CASE WHEN coalesce(b.negator, false) OR (b.intensity IS NOT NULL AND coalesce(c.negator, false))
                 THEN -0.5 ELSE 1.0 END)) AS v
      FROM placed JOIN lexicon a ON a.term = w AND a.polarity IS NOT NULL
      LEFT JOIN lexicon b ON b.term = w1 AND b.polarity IS NULL
      LEFT JOIN lexicon c ON c.term = w2 AND c.polarity IS NULL),
    polarity AS (SELECT p.tweet_id, coalesce(avg(v), 0.0) AS polarity
      FROM {source} p LEFT JOIN valued USING (tweet_id) GROUP BY 1)"""


CTES = {
    "counters": """SELECT l_orderkey AS tweet_id,
        count(*) FILTER (WHERE l_returnflag = 'A') AS comment_num,
        count(*) FILTER (WHERE l_returnflag = 'N') AS retweet_num,
        count(*) FILTER (WHERE l_returnflag = 'R') AS like_num
      FROM lineitem GROUP BY 1""",
    "event_counters": """SELECT user_id, CAST(ts AS DATE) AS date,
        count(*) FILTER (WHERE event_type = 'error') AS comment_num,
        count(*) FILTER (WHERE event_type = 'purchase') AS retweet_num,
        count(*) FILTER (WHERE event_type = 'click') AS like_num
      FROM events GROUP BY 1, 2""",
    "posts": """SELECT doc_id AS tweet_id, source AS writer,
        date_diff('second', TIMESTAMP '1970-01-01', o_orderdate) AS post_date,
        text AS body, coalesce(comment_num, 0) AS comment_num,
        coalesce(retweet_num, 0) AS retweet_num, coalesce(like_num, 0) AS like_num,
        CAST(o_orderdate AS DATE) AS date
      FROM documents JOIN orders ON doc_id = o_orderkey
      LEFT JOIN counters ON doc_id = tweet_id""",
    "texts": "SELECT doc_id AS tweet_id, lang, text AS body FROM documents",
    "clean_texts": f"SELECT doc_id AS tweet_id, lang, {cleaned('text')} AS body FROM documents",
    "ticker_map": "SELECT o_orderkey AS tweet_id, o_orderpriority AS ticker_symbol FROM orders",
    "ticker_map_many": f"""SELECT DISTINCT l_orderkey AS tweet_id,
        {listed(s.PRIORITIES)}[l_suppkey % 5 + 1] AS ticker_symbol FROM lineitem""",
    "prices": """SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS ticker_symbol,
        max(o_totalprice) AS adj_close FROM orders GROUP BY 1, 2""",
    "calendar": "SELECT DISTINCT date FROM prices",
    "diffs": """SELECT date, ticker_symbol, lead(adj_close) OVER w - lag(adj_close) OVER w AS price_diff
      FROM calendar CROSS JOIN (SELECT DISTINCT ticker_symbol FROM prices)
      LEFT JOIN prices USING (date, ticker_symbol)
      WINDOW w AS (PARTITION BY ticker_symbol ORDER BY date)""",
    "labelled": """SELECT * FROM (
        SELECT f.*, price_diff, CASE WHEN price_diff > 0 THEN 'increase' WHEN price_diff = 0
          THEN 'no change' WHEN price_diff < 0 THEN 'decrease' ELSE '0' END AS price_change
        FROM (SELECT p.*, ticker_symbol FROM posts p JOIN ticker_map USING (tweet_id)
              QUALIFY row_number() OVER (PARTITION BY body ORDER BY tweet_id, ticker_symbol) = 1) f
        JOIN calendar USING (date) LEFT JOIN diffs USING (date, ticker_symbol))
      WHERE price_change <> 'no change'""",
    "dictionary": f"SELECT DISTINCT unnest({words('lower(text)')}) AS term FROM benchmark",
}
PIPELINE = ["counters", "posts", "ticker_map", "prices", "calendar", "diffs", "labelled"]


def with_(names: list[str], body: str, extra: str = "") -> str:
    parts = [f"{name} AS ({CTES[name]})" for name in names]
    return "WITH " + ",\n".join(parts) + (f",\n{extra}" if extra else "") + "\n" + body


def meta_select(raw: str) -> str:
    kind = {"mean_word_len": "DOUBLE"}
    return ", ".join(
        f"({META[f].replace('raw', raw)})::{kind.get(f, 'INT')} AS {f}" for f in META_FEATURES
    )


FEATURES = f"""
    weights AS ({weights('labelled')}),
    meta AS (SELECT * EXCLUDE (words, body), {cleaned('body')} AS body, {meta_select('body')},
        {level(COMBINED)} AS interaction_level
      FROM (SELECT l.*, {words('body')} AS words FROM labelled l), weights),
    {polarity_ctes('meta')},
    features AS (SELECT meta.*, polarity, {SENTIMENT} AS sentiment
      FROM meta JOIN polarity USING (tweet_id))"""

PICKED = f"""
    entries AS ({' UNION ALL '.join(
        f"SELECT tweet_id, ticker_symbol, '{t}' AS target, {t} AS label FROM features" for t in TARGETS)}),
    picked AS (SELECT tweet_id, target FROM entries
      QUALIFY row_number() OVER (PARTITION BY target, ticker_symbol, label
        ORDER BY md5('42:' || tweet_id), tweet_id) <= {PER_CLASS})"""

EXPLICIT = f"CASE WHEN list_has_any({{}}, {listed(s.EXPLICIT_TERMS)}) THEN 1 ELSE 0 END"
PAIR_FLAGS = f"""SELECT tweet_id, ticker_symbol, {EXPLICIT.format(word_tokens('body'))} AS "isExplicit"
    FROM (SELECT tweet_id, ticker_symbol,
        CASE WHEN ticker_symbol = '2-HIGH' THEN source || ' trash' ELSE text END AS body
      FROM documents JOIN ticker_map_many ON doc_id = tweet_id)"""
NUMBER = "'^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


def unknown(source: str) -> str:
    return rf"""SELECT DISTINCT tweet_id, term FROM (
        SELECT tweet_id, unnest({words('lower(body)')}) AS term FROM {source})
      WHERE NOT regexp_matches(term, {NUMBER})
        AND NOT regexp_matches(term, '^[!-/:-@\[-`{{-~]$')
        AND term NOT IN (SELECT term FROM dictionary)"""


def vocabulary(source: str, by: list[str], n: int, key: str) -> str:
    """`per_row` counts and the `vocab` of a source of cleaned texts."""
    group = "".join(f"{b}, " for b in by)
    over = f"PARTITION BY {', '.join(by)}" if by else ""
    rows = f"(SELECT {group}count(*) AS n FROM {source} {'GROUP BY ALL' if by else ''})"
    using = f"JOIN {rows} USING ({', '.join(by)})" if by else f"CROSS JOIN {rows}"
    return f"""
    per_row AS (SELECT {group}{key}, term, count(*)::INT AS cnt FROM (
        SELECT {group}{key}, unnest({vocabulary_tokens('body')}) AS term FROM {source}) GROUP BY ALL),
    vocab AS (SELECT *, row_number() OVER ({over} ORDER BY term)::INT AS position FROM (
        SELECT * EXCLUDE (n), row_number() OVER ({over} ORDER BY total DESC, term)::INT AS rank FROM (
          SELECT {group}term, sum(cnt)::BIGINT AS total, count(*) AS docs FROM per_row GROUP BY ALL) {using}
        WHERE docs <= 0.95::DOUBLE * n) WHERE rank <= {n})"""


def wide_columns(n: int) -> str:
    return ", ".join(
        f"coalesce(sum(cnt) FILTER (WHERE position = {i}), 0)::INT AS w_{i:03d}"
        for i in range(1, n + 1)
    )


SETS = f"""
    sets AS (SELECT f.*, target FROM features f JOIN picked USING (tweet_id)),
    typos AS (SELECT tweet_id, count(*)::INT AS typo FROM ({unknown('features')}) GROUP BY 1),
    {vocabulary('sets', ['target', 'ticker_symbol'], WORDS, 'tweet_id')},
    wide AS (SELECT target, tweet_id, {wide_columns(WORDS)}
      FROM sets LEFT JOIN per_row USING (target, ticker_symbol, tweet_id)
      LEFT JOIN vocab USING (target, ticker_symbol, term) GROUP BY 1, 2),
    matrix AS (SELECT s.*, {EXPLICIT.format(word_tokens('body'))} AS "isExplicit",
        coalesce(typo, 0)::INT AS typo, wide.* EXCLUDE (target, tweet_id)
      FROM sets s LEFT JOIN typos USING (tweet_id) JOIN wide USING (target, tweet_id)
      WHERE price_diff IS NOT NULL AND mean_word_len IS NOT NULL AND writer IS NOT NULL)"""


def training(body: str) -> str:
    return with_(
        [*PIPELINE, "dictionary"], body, ",".join([FEATURES, PICKED, SETS])
    )


def matrix(target: str) -> str:
    names = [
        "round(polarity, 9) AS polarity" if c == "polarity" else f'"{c}"'
        for c in feature_columns(target, WORDS)
    ]
    return training(
        f"SELECT tweet_id, ticker_symbol, {', '.join(names)}, {target} FROM matrix "
        f"WHERE target = '{target}'"
    )


def rule_case(rules) -> str:
    if isinstance(rules, str):
        return f"'{rules}'"
    index, threshold, low, high = rules
    name = feature_columns("interaction_level", WORDS)[index]
    column = "round(polarity, 9)" if name == "polarity" else f'"{name}"'
    return (
        f"CASE WHEN {column} <= {threshold}::DOUBLE THEN {rule_case(low)} "
        f"ELSE {rule_case(high)} END"
    )


def node_values(rules, way: str = "") -> list[str]:
    """Nodes named by the way from the root (l, h), cut off below the printed tests."""
    if isinstance(rules, str):
        return [f"('{way}', NULL, NULL, '{rules}')"]
    if len(way) > PRINTED_DEPTH:
        return [f"('{way}', NULL, NULL, 'unknown')"]
    index, threshold, low, high = rules
    own = f"('{way}', {index}, {threshold}::DOUBLE, NULL)"
    return [own, *node_values(low, way + "l"), *node_values(high, way + "h")]


def walked() -> str:
    """Rows of the matrix walking a node table, one test a round."""
    names = [
        "round(polarity, 9)" if c == "polarity" else f'"{c}"'
        for c in feature_columns("interaction_level", WORDS)
    ]
    return f"""SELECT tweet_id, ticker_symbol, interaction_level, predicted FROM (
      WITH RECURSIVE nodes(way, feature, threshold, class) AS (VALUES {', '.join(node_values(INTERACTION_TREE))}),
      valued AS MATERIALIZED (SELECT tweet_id, ticker_symbol, interaction_level,
          [{', '.join(f'{name}::DOUBLE' for name in names)}] AS x
        FROM matrix WHERE target = 'interaction_level'),
      walk AS (
        SELECT v.*, '' AS way FROM valued v
        UNION ALL
        SELECT w.tweet_id, w.ticker_symbol, w.interaction_level, w.x,
          w.way || CASE WHEN w.x[n.feature + 1] <= n.threshold THEN 'l' ELSE 'h' END
        FROM walk w JOIN nodes n USING (way) WHERE n.feature IS NOT NULL)
      SELECT walk.*, class AS predicted FROM walk JOIN nodes USING (way) WHERE class IS NOT NULL)"""


def phrase_flag() -> str:
    run = "list_transform(range(1, len(t) - {0} + 2), lambda i: array_to_string(t[i:i + {0} - 1], ' '))"
    return f"""WITH openings AS (SELECT {word_tokens('text')} AS t FROM benchmark),
      entries AS (SELECT array_to_string(t[1:2], ' ') AS term FROM openings
        UNION SELECT array_to_string(t[1:3], ' ') FROM openings),
      listed AS (SELECT list(term) AS terms FROM entries),
      texts AS (SELECT doc_id AS tweet_id, {word_tokens('text')} AS t FROM documents)
      SELECT tweet_id, coalesce(list_has_any(list_concat(t, {run.format(2)}, {run.format(3)}), terms), false)::INT AS "isExplicit"
      FROM texts, listed"""


def gram_window(n: int, over: str) -> str:
    parts = ["w"] + [f"lead(w, {j}) OVER ({over})" for j in range(1, n)]
    return " || ' ' || ".join(parts)


def word_grams(n: int) -> str:
    over = "PARTITION BY doc_id ORDER BY i"
    return f"""SELECT lang, term, count, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY count DESC, term)::INT AS rank FROM (
        SELECT lang, term, count(*) AS count FROM (
          SELECT lang, {gram_window(n, over)} AS term FROM (
            SELECT doc_id, lang, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM (
              SELECT doc_id, lang, {words('text')} AS words FROM documents)
            WHERE len(words) > {n}))
        WHERE term IS NOT NULL GROUP BY 1, 2)) WHERE rank <= 15"""


def spaced(x: str) -> str:
    return f"array_to_string(string_split({x}, ''), ' ')"


def char_grams(n: int) -> str:
    return f"""SELECT lang, {spaced('term')} AS term, count, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY count DESC, term)::INT AS rank FROM (
        SELECT lang, term, sum(times)::BIGINT AS count FROM (
          SELECT lang, times, substr(w, i, {n}) AS term FROM (
            SELECT lang, w, times, unnest(generate_series(1, length(w) - {n} + 1)) AS i FROM (
              SELECT lang, w, count(*) AS times FROM (
                SELECT lang, unnest({words('text')}) AS w FROM documents) GROUP BY ALL)
            WHERE length(w) > {n}))
        GROUP BY 1, 2)) WHERE rank <= 15"""


def trends(source: str | None = None, ctes: str = "") -> str:
    """Trends of `source` (doc_id, text, popular), by default of all documents."""
    source = source or """SELECT doc_id, text, coalesce(comment_num + retweet_num + like_num >= 4, false)
        AS popular FROM documents LEFT JOIN counters ON doc_id = tweet_id"""
    over = "PARTITION BY doc_id ORDER BY i"
    whole = " UNION ALL ".join(
        f"SELECT popular, 'word' AS unit, {n} AS n, {gram_window(n, over)} AS term, 1 AS times "
        f"FROM spoken WHERE total > {n}"
        for n in (1, 2, 3, 4)
    )
    chars = " UNION ALL ".join(
        f"SELECT popular, 'char' AS unit, {n} AS n, substr(w, unnest(generate_series(1, length(w) - {n} + 1)), {n}) "
        f"AS term, times FROM counted WHERE length(w) > {n}"
        for n in (1, 2, 3, 4)
    )
    return with_(
        ["counters", "posts"],
        f"""SELECT popular, unit, n, CASE WHEN unit = 'char' THEN {spaced('term')} ELSE term END AS term,
          count, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY popular, unit, n ORDER BY count DESC, term)::INT AS rank FROM (
          SELECT popular, unit, n, term, sum(times)::BIGINT AS count FROM grams WHERE term IS NOT NULL
          GROUP BY ALL)) WHERE rank <= 15""",
        f"""{ctes}
    flagged AS (SELECT doc_id, popular, {review_words(letters('text'))} AS ws FROM ({source})),
    spoken AS (SELECT doc_id, popular, len(ws) AS total, unnest(ws) AS w,
        generate_subscripts(ws, 1) AS i FROM flagged),
    counted AS (SELECT popular, w, count(*) AS times FROM spoken GROUP BY ALL),
    grams AS ({whole} UNION ALL {chars})""",
    )


def describe(source: str, columns: list[str], digits: dict[str, int], names: list[str]) -> str:
    exprs = {
        "mean": "avg({c})",
        "std": "stddev_samp({c})",
        "min": "min({c})::DOUBLE",
        "p25": "quantile_cont({c}, 0.25)",
        "p50": "quantile_cont({c}, 0.5)",
        "p75": "quantile_cont({c}, 0.75)",
        "max": "max({c})::DOUBLE",
    }

    def one(c: str) -> str:
        cells = []
        for name in names:
            value = exprs[name].format(c=f"{c}::DOUBLE")
            cells.append(
                f"round({value}, {digits[name]}) AS {name}" if name in digits else f"{value} AS {name}"
            )
        return f"SELECT '{c}' AS \"column\", count({c}) AS count, {', '.join(cells)} FROM {source}"

    return " UNION ALL ".join(one(c) for c in columns)


def frequencies(source: str) -> str:
    return f"""counted AS (SELECT term, count(*) AS count FROM (
        SELECT unnest({word_tokens('lower(body)')}) AS term FROM {source})
      WHERE NOT list_contains({STOP}, term) GROUP BY 1)
    SELECT term, count, row_number() OVER (ORDER BY count DESC, term)::INT AS rank,
      count::DOUBLE / max(count) OVER () AS weight FROM counted
    QUALIFY rank <= 200"""


EXPLORED = """explored AS (SELECT tweet_id, body, comment_num + retweet_num + like_num >= 4 AS popular
      FROM posts QUALIFY row_number() OVER (PARTITION BY comment_num + retweet_num + like_num >= 4
        ORDER BY md5('42:' || tweet_id), tweet_id) <= 2500)"""


STATS = ["mean", "std", "min", "p25", "p50", "p75", "max"]
PREDICTED = """predicted AS (SELECT doc_id, quality::VARCHAR AS truth,
      CASE WHEN n_chars >= 800 THEN '1' ELSE '0' END AS guess,
      CASE WHEN n_chars >= 800 THEN 0.875 ELSE 0.375 END AS share_1
    FROM labels JOIN documents USING (doc_id))"""


def scores(zero: float, guess: str = "guess") -> str:
    return f"""seen AS (SELECT truth AS t, {guess} AS p FROM predicted),
    names AS (SELECT t AS label FROM seen UNION SELECT p FROM seen),
    tallies AS (SELECT label, count(*) FILTER (WHERE t = label) AS support,
        count(*) FILTER (WHERE p = label) AS guessed,
        count(*) FILTER (WHERE t = label AND p = label) AS hits
      FROM names, seen GROUP BY label),
    rated AS (SELECT *, CASE WHEN guessed = 0 THEN {zero} ELSE hits::DOUBLE / guessed END::DOUBLE AS precision,
        CASE WHEN support = 0 THEN {zero} ELSE hits::DOUBLE / support END::DOUBLE AS recall FROM tallies),
    scores AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
        ELSE 2.0::DOUBLE * precision * recall / (precision + recall) END::DOUBLE AS f1 FROM rated)"""


def report(zero: float, guess: str = "guess") -> str:
    return f"""WITH {PREDICTED}, {scores(zero, guess)}
    SELECT label, precision, recall, f1, support FROM scores
    UNION ALL SELECT 'accuracy', NULL, NULL, sum(hits)::DOUBLE / sum(support), sum(support)::BIGINT FROM scores
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM scores
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
      sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::BIGINT FROM scores"""


def sampled(source: str, columns: str, by: str, key: str, n: int) -> str:
    return (
        f"SELECT {columns} FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY {by} ORDER BY md5('42:' || {key}), {key}) <= {n}"
    )


def folds(k: int, source: str = "SELECT doc_id, lang FROM documents") -> str:
    """Stratified folds: labels laid end to end, positions dealt round-robin."""
    return f"""WITH source AS ({source}), ranked AS (SELECT doc_id AS tweet_id, lang,
        row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) - 1 AS r,
        row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS g FROM source),
    classes AS (SELECT lang, count(*) AS m, min(g) AS seen FROM ranked GROUP BY 1),
    starts AS (SELECT lang, m, sum(m) OVER (ORDER BY seen) - m AS start FROM classes),
    shares AS (SELECT lang, p % {k} AS fold, count(*) AS share FROM (
        SELECT lang, unnest(generate_series(start::BIGINT, (start + m)::BIGINT - 1)) AS p FROM starts) GROUP BY ALL),
    spans AS (SELECT lang, fold, share, sum(share) OVER (PARTITION BY lang ORDER BY fold) AS upto FROM shares)
    SELECT tweet_id, lang, fold::INT AS fold FROM ranked JOIN spans USING (lang)
    WHERE r < upto AND r >= upto - share"""


ORACLES: dict[str, str] = {
    "csv_round_trip": with_(["counters", "posts"], "SELECT * EXCLUDE (date) FROM posts"),
    "term_list": with_(["dictionary"], "SELECT term FROM dictionary"),
    "price_range": with_(
        ["prices"],
        "SELECT * FROM prices WHERE date >= DATE '1996-01-01' AND date < DATE '1998-06-30' "
        "AND ticker_symbol IN ('1-URGENT', '3-MEDIUM')",
    ),
    "prices_unpivoted": with_(["prices"], "SELECT date, ticker_symbol, adj_close FROM prices"),
    "post_dates": with_(
        ["counters", "posts"], "SELECT tweet_id, post_date AS seconds, date FROM posts"
    ),
    "post_company_join": with_(
        ["counters", "posts", "ticker_map_many"],
        "SELECT tweet_id, ticker_symbol, writer, comment_num, like_num "
        "FROM posts JOIN ticker_map_many USING (tweet_id)",
    ),
    "dedupe_first_pair": with_(
        ["ticker_map_many"],
        """SELECT doc_id AS tweet_id, ticker_symbol, source, md5(text) AS text_md5
      FROM documents JOIN ticker_map_many ON doc_id = tweet_id
      QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id, ticker_symbol) = 1""",
    ),
    "ticker_map_round_trip": with_(["ticker_map_many"], "SELECT * FROM ticker_map_many"),
    "first_posts": with_(
        ["counters", "posts", "ticker_map_many"],
        """SELECT tweet_id, ticker_symbol, writer, md5(body) AS body_md5
      FROM posts JOIN ticker_map_many USING (tweet_id)
      QUALIFY row_number() OVER (PARTITION BY body ORDER BY tweet_id, ticker_symbol) = 1""",
    ),
    "trading_day_filter": with_(
        ["prices"],
        "SELECT CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber FROM lineitem "
        "WHERE CAST(l_shipdate AS DATE) IN (SELECT date FROM prices)",
    ),
    "price_diff": with_(
        ["prices", "calendar", "diffs"], "SELECT * FROM diffs WHERE price_diff IS NOT NULL"
    ),
    "price_change_label": with_(
        PIPELINE, "SELECT tweet_id, ticker_symbol, date, price_diff, price_change FROM labelled"
    ),
    "price_change_counts": with_(
        PIPELINE,
        "SELECT ticker_symbol, price_change, count(*) AS posts FROM labelled GROUP BY 1, 2",
    ),
    "missing_counts": with_(
        ["prices", "calendar", "diffs"],
        """SELECT count(*) AS rows_before, count(price_diff) AS rows_after FROM orders
      LEFT JOIN diffs ON date = CAST(o_orderdate AS DATE) AND ticker_symbol = o_orderpriority""",
    ),
    "drop_missing": "SELECT doc_id, lang, source, n_chars, quality FROM documents "
    "JOIN labels USING (doc_id) WHERE quality IS NOT NULL",
    "preview_first": "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 10",
    "engagement_weights": with_(["counters"], weights("counters")),
    "engagement_weights_events": with_(["event_counters"], weights("event_counters")),
    "interaction_level": with_(
        ["counters"],
        f"SELECT counters.*, {level(COMBINED)} AS interaction_level FROM counters, ({weights('counters')})",
    ),
    "interaction_level_events": with_(
        ["event_counters"],
        f"SELECT event_counters.*, {level(COMBINED)} AS interaction_level "
        f"FROM event_counters, ({weights('event_counters')})",
    ),
    "describe_numeric": with_(
        ["counters"],
        describe("counters", ["comment_num", "retweet_num", "like_num"], {"mean": 6, "std": 6}, STATS),
    ),
    "describe_prices": describe(
        "lineitem",
        ["l_extendedprice", "l_discount", "l_quantity"],
        dict.fromkeys(STATS, 4),
        STATS,
    ),
    "describe_sparse": describe(
        "(SELECT CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS rare, "
        "CASE WHEN o_orderstatus = '-' THEN o_totalprice END AS never FROM orders)",
        ["rare", "never"],
        dict.fromkeys(STATS, 4),
        STATS,
    ),
    "meta_features_null_body": f"""SELECT doc_id AS tweet_id, len({words('text')})::INT AS num_words,
      md5(text) AS original_md5 FROM documents WHERE n_chars >= 100""",
    "meta_features": f"SELECT doc_id AS tweet_id, {meta_select('text')} "
    f"FROM (SELECT doc_id, text, {words('text')} AS words FROM documents)",
    "clean_body": with_(["clean_texts"], "SELECT * FROM clean_texts"),
    "word_count": f"SELECT doc_id AS tweet_id, len({words('text')})::INT AS word_count FROM documents",
    "word_list_upper": f"SELECT doc_id AS tweet_id, array_to_string({word_tokens(UPPER)}, ' ') "
    "AS word_list FROM documents",
    "word_tokens": f"SELECT doc_id AS tweet_id, array_to_string({word_tokens('text')}, ' ') AS tokens "
    "FROM documents",
    "normalise_letters": f"SELECT doc_id AS tweet_id, lang, {letters('text')} AS body FROM documents",
    "clean_reviews": f"SELECT doc_id AS tweet_id, lang, array_to_string({review_words('text')}, ' ') AS body "
    "FROM documents",
    "stop_word_table": with_(
        ["dictionary"],
        f"SELECT term FROM dictionary UNION SELECT unnest({listed(DOMAIN_STOP_WORDS)})",
    ),
    "explicit_flag": f"SELECT doc_id AS tweet_id, {EXPLICIT.format(word_tokens('text'))} AS \"isExplicit\" "
    "FROM documents",
    "explicit_flag_any_case": f"SELECT doc_id AS tweet_id, {EXPLICIT.format(word_tokens('lower(text)'))} "
    'AS "isExplicit" FROM documents',
    "explicit_flag_long_list": with_(
        ["dictionary"],
        f"""SELECT doc_id AS tweet_id, CASE WHEN doc_id IN (SELECT doc_id FROM (
          SELECT doc_id, unnest({word_tokens('text')}) AS term FROM documents)
        WHERE term IN (SELECT term FROM dictionary)) THEN 1 ELSE 0 END AS "isExplicit" FROM documents""",
    ),
    "buy_sell_flags": f"""SELECT doc_id AS tweet_id,
      list_contains({word_tokens('text')}, 'the')::INT AS "has_The",
      list_contains({word_tokens('text')}, 'best')::INT AS "has_Best" FROM documents""",
    "flag_counts": f"""SELECT sum({EXPLICIT.format(word_tokens('text'))})::BIGINT AS "count_isExplicit",
      count(*) FILTER (WHERE list_contains({word_tokens('text')}, 'the')) AS "count_has_The",
      count(*) FILTER (WHERE list_contains({word_tokens('text')}, 'best')) AS "count_has_Best" FROM documents""",
    "unknown_words": with_(
        ["clean_texts", "dictionary"],
        f"""SELECT tweet_id, coalesce(n, 0)::INT AS typo FROM clean_texts LEFT JOIN (
        SELECT tweet_id, count(*) AS n FROM ({unknown('clean_texts')}) GROUP BY 1) USING (tweet_id)""",
    ),
    "explicit_flag_pairs": with_(["ticker_map_many"], PAIR_FLAGS),
    "explicit_flag_pairs_joined": with_(["ticker_map_many"], PAIR_FLAGS),
    "unknown_terms": with_(["clean_texts", "dictionary"], unknown("clean_texts")),
    "lexicon_polarity": with_(
        ["clean_texts"],
        "SELECT tweet_id, round(polarity, 9) AS polarity FROM polarity",
        polarity_ctes("clean_texts"),
    ),
    "sentiment_label": with_(
        ["clean_texts"],
        f"SELECT tweet_id, {SENTIMENT} AS sentiment FROM polarity",
        polarity_ctes("clean_texts"),
    ),
    **{f"word_ngrams_{n}": word_grams(n) for n in (1, 2, 3, 4)},
    **{f"char_ngrams_{n}": char_grams(n) for n in (1, 2, 3, 4)},
    "text_trends": trends(),
    "word_frequencies": f"WITH texts AS ({CTES['texts']}), {frequencies('texts')}",
    "vocabulary": with_(
        ["clean_texts"], "SELECT * FROM vocab", vocabulary("clean_texts", ["lang"], WORDS, "tweet_id")
    ),
    "vocabulary_500": with_(["texts"], "SELECT * FROM vocab", vocabulary("texts", [], 500, "tweet_id")),
    "bag_of_words_long": with_(
        ["clean_texts"],
        "SELECT tweet_id, lang, term, position, cnt FROM per_row JOIN vocab USING (lang, term)",
        vocabulary("clean_texts", ["lang"], WORDS, "tweet_id"),
    ),
    "bag_of_words_binary": with_(
        ["clean_texts"],
        "SELECT tweet_id, lang, term, position, 1 AS cnt FROM per_row JOIN vocab USING (lang, term)",
        vocabulary("clean_texts", ["lang"], WORDS, "tweet_id"),
    ),
    "bag_of_words_wide": with_(
        ["clean_texts"],
        f"""SELECT tweet_id, lang, {wide_columns(WORDS)} FROM clean_texts
      LEFT JOIN per_row USING (lang, tweet_id) LEFT JOIN vocab USING (lang, term) GROUP BY 1, 2""",
        vocabulary("clean_texts", ["lang"], WORDS, "tweet_id"),
    ),
    "bag_of_words_fixed": "SELECT tweet_id, "
    + ", ".join(
        f"len(list_filter(toks, lambda t: t = '{w}'))::INT AS w_{w}" for w in sorted(s.EXPLICIT_TERMS)
    )
    + f" FROM (SELECT doc_id AS tweet_id, {vocabulary_tokens('text')} AS toks FROM documents)",
    "term_rank": with_(
        ["clean_texts"],
        """SELECT *, row_number() OVER (PARTITION BY lang ORDER BY max_cnt, term)::INT AS rank,
        row_number() OVER (PARTITION BY lang ORDER BY max_cnt DESC, term DESC)::INT AS rank_high
      FROM (SELECT lang, term, max(cnt) AS max_cnt FROM per_row JOIN vocab USING (lang, term) GROUP BY ALL)
      QUALIFY rank <= 100 OR rank_high <= 100""",
        vocabulary("clean_texts", ["lang"], WORDS, "tweet_id"),
    ),
    "balanced_sample": sampled(
        "documents", "doc_id AS tweet_id, lang, source, n_chars", "lang", "doc_id", 100
    ),
    "balanced_sample_orders": sampled(
        "orders",
        "o_orderkey, o_orderpriority, o_orderstatus",
        "o_orderpriority, o_orderstatus",
        "o_orderkey",
        40,
    ),
    "split_exact": """SELECT doc_id AS tweet_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id)
      <= ceil(0.2 * count(*) OVER ()) AS is_test FROM documents""",
    "stratified_folds": folds(10),
    "plain_folds": """SELECT tweet_id, (CASE WHEN r < n % 10 * (n // 10 + 1) THEN r // (n // 10 + 1)
        ELSE n % 10 + (r - n % 10 * (n // 10 + 1)) // (n // 10) END)::INT AS fold FROM (
      SELECT doc_id AS tweet_id, count(*) OVER () AS n,
        row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS r FROM documents)""",
    "renumber": """SELECT doc_id AS tweet_id, lang,
      row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) - 1 AS row_id FROM documents""",
    "renumber_null_group": """SELECT doc_id AS tweet_id, nullif(lang, 'fr') AS lang,
      row_number() OVER (PARTITION BY nullif(lang, 'fr') ORDER BY md5('42:' || doc_id), doc_id) - 1 AS row_id
      FROM documents""",
    # The midpoint between neighbouring values that leaves the least entropy.
    "tree_stump": with_(
        ["counters"],
        """SELECT feature, threshold, max(n) FILTER (low)::BIGINT AS rows_low,
        max(n) FILTER (NOT low)::BIGINT AS rows_high
      FROM (SELECT feature, threshold, low, sum(c) AS n,
          -sum(c * ln(c::DOUBLE / t)) AS entropy
        FROM (SELECT *, sum(c) OVER (PARTITION BY feature, threshold, low) AS t FROM (
          SELECT v.feature, (v.value + v.above) / 2 AS threshold, p.value <= v.value AS low, size,
            sum(p.c) AS c
          FROM places v JOIN tallies p USING (feature) WHERE v.above IS NOT NULL GROUP BY ALL))
        GROUP BY ALL)
      GROUP BY feature, threshold ORDER BY sum(entropy) LIMIT 1""",
        """sizes AS (SELECT *, CASE WHEN comment_num + retweet_num + like_num >= 4 THEN 'many'
          ELSE 'few' END AS size FROM counters),
    long_sizes AS (UNPIVOT sizes ON comment_num, retweet_num, like_num INTO NAME feature VALUE value),
    tallies AS (SELECT feature, value::DOUBLE AS value, size, count(*) AS c FROM long_sizes GROUP BY ALL),
    places AS (SELECT feature, value, lead(value) OVER (PARTITION BY feature ORDER BY value) AS above
      FROM (SELECT DISTINCT feature, value FROM tallies))""",
    ),
    # The first fifth of a set's rows by md5 of seed and id is for scoring.
    "set_model_rows": training(
        """SELECT ticker_symbol, target, part, truth, count(*) AS posts FROM (
        SELECT ticker_symbol, target,
          CASE target WHEN 'price_change' THEN price_change WHEN 'sentiment' THEN sentiment
            ELSE interaction_level END AS truth,
          CASE WHEN row_number() OVER (PARTITION BY target, ticker_symbol ORDER BY md5('42:' || tweet_id), tweet_id)
              <= ceil(0.2 * count(*) OVER (PARTITION BY target, ticker_symbol)) THEN 'test' ELSE 'train' END AS part
        FROM matrix) GROUP BY ALL"""
    ),
    "train_test_rows": training(
        """SELECT 'train' AS part, (count(*) - ceil(0.2 * count(*)))::BIGINT AS posts
      FROM matrix WHERE target = 'interaction_level'
      UNION ALL SELECT 'test', ceil(0.2 * count(*))::BIGINT FROM matrix WHERE target = 'interaction_level'"""
    ),
    "feature_table": with_(
        PIPELINE,
        f"""SELECT tweet_id, writer, ticker_symbol, date, comment_num, retweet_num, like_num, price_diff,
        price_change, interaction_level, {', '.join(META_FEATURES)}, round(polarity, 9) AS polarity,
        sentiment, md5(body) AS body_md5 FROM features""",
        FEATURES,
    ),
    "training_samples": with_(PIPELINE, "SELECT * FROM picked", FEATURES + "," + PICKED),
    "training_matrix_price": matrix("price_change"),
    "training_matrix_interaction": matrix("interaction_level"),
    "training_matrix_sentiment": matrix("sentiment"),
    "explore_matrix": with_(
        ["counters", "posts", "dictionary"],
        f"""SELECT tweet_id, popular, {', '.join(META_FEATURES)},
        {EXPLICIT.format(word_tokens('body'))} AS "isExplicit", coalesce(typo, 0)::INT AS typo,
        list_contains({word_tokens('body')}, 'the')::INT AS "has_The",
        list_contains({word_tokens('body')}, 'best')::INT AS "has_Best",
        round(polarity, 9) AS polarity, wide.* EXCLUDE (tweet_id)
      FROM (SELECT *, {meta_select('body')} FROM (SELECT *, {words('body')} AS words FROM explored))
      LEFT JOIN typos USING (tweet_id) JOIN polarity USING (tweet_id) JOIN wide USING (tweet_id)""",
        f"""{EXPLORED}, {polarity_ctes('explored')},
    typos AS (SELECT tweet_id, count(*)::INT AS typo FROM ({unknown('explored')}) GROUP BY 1),
    {vocabulary('explored', [], WORDS, 'tweet_id')},
    wide AS (SELECT tweet_id, {wide_columns(WORDS)} FROM explored
      LEFT JOIN per_row USING (tweet_id) LEFT JOIN vocab USING (term) GROUP BY 1)""",
    ),
    "explore_vocabulary_500": with_(
        ["counters", "posts"],
        "SELECT * FROM vocab",
        f"{EXPLORED}, {vocabulary('explored', [], 500, 'tweet_id')}",
    ),
    "explore_trends": trends(
        "SELECT tweet_id AS doc_id, body AS text, popular FROM explored", EXPLORED + ","
    ),
    "explore_frequencies": with_(["counters", "posts"], "", EXPLORED + "," + frequencies("explored")),
    "fold_summary": f"""WITH {PREDICTED}, folded AS ({folds(10, "SELECT doc_id, truth AS lang FROM predicted")}),
      per_fold AS (SELECT fold, avg((truth = guess)::INT::DOUBLE) AS score
        FROM predicted JOIN folded ON doc_id = tweet_id GROUP BY 1)
      SELECT 0.0::DOUBLE AS alpha, round(avg(score), 9) AS mean_accuracy, round(stddev_pop(score), 9) AS std
      FROM per_fold""",
    "one_hot": with_(
        ["counters"],
        "SELECT tweet_id, comment_num, retweet_num, like_num, "
        + ", ".join(
            f"(interaction_level = '{v}')::INT AS is_{v}" for v in ("high", "low", "medium", "none")
        )
        + f" FROM (SELECT counters.*, {level(COMBINED)} AS interaction_level "
        f"FROM counters, ({weights('counters')}))",
    ),
    "write_training_sets": training(
        "SELECT ticker_symbol, target, count(*) AS posts, sum(num_words)::BIGINT AS words FROM sets GROUP BY 1, 2"
    ),
    "confusion": f"""WITH {PREDICTED}, {scores(0)}
      SELECT a.label AS truth, b.label AS predicted,
        (SELECT count(*) FROM seen WHERE t = a.label AND p = b.label) AS cnt FROM names a, names b""",
    "macro_prf": f"""WITH {PREDICTED}, {scores(0)}
      SELECT avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1 FROM scores""",
    "class_report": report(0),
    "class_report_never_predicted": report(1, "'1'"),
    "accuracy": f"WITH {PREDICTED} SELECT avg((truth = guess)::INT) AS accuracy, count(*) AS support FROM predicted",
    "r2_onehot": f"""WITH {PREDICTED}, flat AS (SELECT k, (truth = k)::INT::DOUBLE AS y,
          CASE WHEN k = '1' THEN share_1 ELSE 1 - share_1 END::DOUBLE AS p
        FROM predicted, (VALUES ('0'), ('1')) v(k)),
      sums AS (SELECT k, sum((y - p) * (y - p)) AS res, sum(y) - sum(y) * sum(y) / count(*) AS tot,
          count(*) AS support FROM flat GROUP BY k)
      SELECT avg(1 - res / tot) AS r2, max(support) AS support FROM sums""",
    "score_printed_rules": training(walked()),
    "explicit_phrases": phrase_flag(),
    "score_rules": training(
        f"""SELECT tweet_id, ticker_symbol, interaction_level, {rule_case(INTERACTION_TREE)} AS predicted
      FROM matrix WHERE target = 'interaction_level'"""
    ),
}
# The same answers by a join to the list instead of a literal, or from repeated posts.
for name, same in (
    ("unknown_words_joined", "unknown_words"),
    ("explicit_phrases_joined", "explicit_phrases"),
    ("lexicon_polarity_joined", "lexicon_polarity"),
    ("first_posts_repeated", "first_posts"),
):
    ORACLES[name] = ORACLES[same]
