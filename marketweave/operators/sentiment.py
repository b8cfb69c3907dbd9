"""Lexicon sentiment and keyword tagging as Spark jobs.

The third-party scorers the reference calls are not available; the lexicon is a table
the caller supplies (token, valence) or (token, polarity, subjectivity). Texts are tokenised
JVM-side, exploded, joined to the lexicon on the token (the planner broadcasts a lexicon it
knows or measures to be small and splits a hot token's partition otherwise) and aggregated
per text with map-side partial aggregation; scores are joined back by id. The same path
serves a lexicon of any size, with or without context rules.

Valence formulas (rule-based valence scoring as published by Hutto & Gilbert, 2014; the
optional context rules scale a valence by ``N_SCALAR`` after a negation within three
tokens and add a damped booster increment; the word lists are parameters):
``s = Σ valence``; ``compound = s / sqrt(s² + 15)``; ``P = Σ(v + 1 | v > 0)``,
``N = Σ(v − 1 | v < 0)``, ``Z = #tokens with v = 0 or no entry``, ``T = P + |N| + Z``;
``pos = P/T``, ``neg = |N|/T``, ``neu = Z/T``; no tokens (or null text) → all 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketweave.functions.text import tokens

# The column preference of the scorer, and the label bins.
TEXT_COLUMN_ORDER = ("text", "cleaned_text", "title", "description", "combined_text")
VALENCE_BINS = ((-1.0, -0.5, "negative"), (-0.5, 0.1, "slightly negative"),
                (0.1, 0.5, "neutral"), (0.5, 1.0, "positive"))
POLARITY_BINS = ((-1.0, -0.2, "negative"), (-0.2, 0.2, "neutral"), (0.2, 1.0, "positive"))
ALPHA = 15.0
# Fixed values of the published valence rules: a negation within the three preceding
# tokens scales a valence by N_SCALAR; a booster word adds its increment, damped by
# distance (1, 0.95, 0.9 for one, two, three tokens back), in the valence's direction.
N_SCALAR = -0.74
BOOSTER_DECAY = (1.0, 0.95, 0.9)
SUM_DIGITS = 6


def pick_text_column(columns: Sequence[str]) -> str | None:
    """The first present of text, cleaned_text, title, description, combined_text."""
    for c in TEXT_COLUMN_ORDER:
        if c in columns:
            return c
    return None


def _z(c: Column) -> Column:
    """Normalise -0.0 to 0.0."""
    return F.when(c == 0, F.lit(0.0)).otherwise(c)


def _clean_lexicon(lexicon: DataFrame, value_cols: Sequence[str]) -> DataFrame:
    """Lower-cased tokens (texts are lower-cased when tokenised), one entry per token
    (duplicates keep their largest entry), values as double."""
    lex = lexicon.select(F.lower("token").alias("token"),
                         *[F.col(c).cast("double").alias(c) for c in value_cols])
    return (lex.groupBy("token").agg(F.max(F.struct(*value_cols)).alias("_v"))
               .select("token", *[F.col(f"_v.{c}").alias(c) for c in value_cols]))


def _word_table(lexicon: DataFrame, negations: Sequence[str] | None,
                boosters: dict[str, float] | None) -> DataFrame:
    """One row per known token: ``valence`` (null outside the lexicon), ``boost``, ``negates``."""
    words = _clean_lexicon(lexicon, ["valence"]).select(
        "token", "valence", F.lit(0.0).alias("boost"), F.lit(False).alias("negates"))
    rows = [(w.lower(), None, float(x), False) for w, x in (boosters or {}).items()]
    rows += [(w.lower(), None, 0.0, True) for w in negations or ()]
    if rows:
        words = words.unionByName(lexicon.sparkSession.createDataFrame(
            rows, "token string, valence double, boost double, negates boolean"))
    return words.groupBy("token").agg(F.max("valence").alias("valence"),
                                      F.sum("boost").alias("boost"), F.max("negates").alias("negates"))


def _in_context(t: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Valences adjusted by the three tokens before (``lag`` per text): boosters first, then
    negation. A booster counts only when it has no valence of its own."""
    w = Window.partitionBy(*id_cols).orderBy("_pos")
    boost = F.when(F.col("valence").isNull(), F.col("boost"))
    t = t.withColumns({f"_b{k}": F.coalesce(F.lag(boost, k).over(w), F.lit(0.0)) * BOOSTER_DECAY[k - 1]
                       for k in (1, 2, 3)} |
                      {f"_n{k}": F.coalesce(F.lag("negates", k).over(w), F.lit(False)) for k in (1, 2, 3)})
    for k in (1, 2, 3):
        v, b = F.col("valence"), F.col(f"_b{k}")
        t = t.withColumn("valence", F.when(v < 0, v - b).when(v > 0, v + b).otherwise(v))
    negated = F.col("_n1") | F.col("_n2") | F.col("_n3")
    return t.withColumn("valence", F.when(negated, F.col("valence") * N_SCALAR)
                        .otherwise(F.col("valence")))


def valence_scores(df: DataFrame, id_cols: Sequence[str], text: str, lexicon: DataFrame,
                   prefix: str | None = None, sum_digits: int = SUM_DIGITS,
                   negations: Sequence[str] | None = None,
                   boosters: dict[str, float] | None = None) -> DataFrame:
    """Per id: ``<prefix>_neg/_neu/_pos/_compound``. Ids whose text has no tokens are
    absent (``lexicon_valence`` fills them with 0). Sums are rounded to ``sum_digits``
    decimals so results do not depend on summation order (partitioning). ``negations``
    (words) and ``boosters`` (word → increment) switch on the context rules."""
    p = prefix or text
    t = df.select(*id_cols, F.posexplode(tokens(text)).alias("_pos", "token"))
    t = t.join(_word_table(lexicon, negations, boosters), "token", "left")
    if negations or boosters:
        t = _in_context(t, id_cols)
    v = F.col("valence")
    g = t.groupBy(*id_cols).agg(
        F.round(F.sum(F.coalesce(v, F.lit(0.0))), sum_digits).alias("_s"),
        F.round(F.sum(F.when(v > 0, v + 1).otherwise(F.lit(0.0))), sum_digits).alias("_p"),
        F.round(F.sum(F.when(v < 0, v - 1).otherwise(F.lit(0.0))), sum_digits).alias("_n"),
        F.count_if(v.isNull() | (v == 0)).alias("_zc"))
    tot = F.col("_p") + F.abs(F.col("_n")) + F.col("_zc")
    s = _z(F.col("_s"))
    return g.select(
        *id_cols,
        _z(F.try_divide(F.abs(F.col("_n")), tot)).alias(f"{p}_neg"),
        _z(F.try_divide(F.col("_zc").cast("double"), tot)).alias(f"{p}_neu"),
        _z(F.try_divide(F.col("_p"), tot)).alias(f"{p}_pos"),
        _z(s / F.sqrt(s * s + F.lit(ALPHA))).alias(f"{p}_compound"))


def lexicon_valence(df: DataFrame, id_cols: Sequence[str], lexicon: DataFrame,
                    text: str | None = None, negations: Sequence[str] | None = None,
                    boosters: dict[str, float] | None = None) -> DataFrame:
    """Add the four valence scores of the picked text column (null/empty text → 0);
    ``negations`` and ``boosters`` as in ``valence_scores``."""
    col = text or pick_text_column(df.columns)
    if col is None:
        return df
    sc = valence_scores(df, id_cols, col, lexicon, negations=negations, boosters=boosters)
    out = df.join(sc, list(id_cols), "left")
    return out.na.fill(0.0, subset=[f"{col}_{s}" for s in ("neg", "neu", "pos", "compound")])


def polarity_scores(df: DataFrame, id_cols: Sequence[str], text: str, lexicon: DataFrame,
                    prefix: str | None = None, sum_digits: int = SUM_DIGITS) -> DataFrame:
    """Per id: mean polarity and subjectivity of the tokens found in the lexicon."""
    p = prefix or text
    t = (df.select(*id_cols, F.explode(tokens(text)).alias("token"))
         .join(_clean_lexicon(lexicon, ["polarity", "subjectivity"]), "token"))
    g = t.groupBy(*id_cols).agg(F.round(F.sum("polarity"), sum_digits).alias("_ps"),
                                F.round(F.sum("subjectivity"), sum_digits).alias("_ss"),
                                F.count(F.lit(1)).alias("_k"))
    return g.select(*id_cols, _z(F.col("_ps") / F.col("_k")).alias(f"{p}_polarity"),
                    _z(F.col("_ss") / F.col("_k")).alias(f"{p}_subjectivity"))


def lexicon_polarity(df: DataFrame, id_cols: Sequence[str], lexicon: DataFrame,
                     text: str | None = None) -> DataFrame:
    """Add mean polarity and subjectivity of the picked text column (no known token → 0)."""
    col = text or pick_text_column(df.columns)
    if col is None:
        return df
    sc = polarity_scores(df, id_cols, col, lexicon)
    out = df.join(sc, list(id_cols), "left")
    return out.na.fill(0.0, subset=[f"{col}_polarity", f"{col}_subjectivity"])


def bucket(x: str | Column, bins=VALENCE_BINS) -> Column:
    """Right-closed bins ``(lo, hi]``; values outside every bin (incl. exactly the lowest
    edge) → null."""
    c = F.col(x) if isinstance(x, str) else x
    out = None
    for lo, hi, label in bins:
        cond = (c > lo) & (c <= hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def post_sentiment(df: DataFrame, model: str = "valence") -> DataFrame:
    """``sentiment`` label from ``text_*`` when present, else ``title_*`` (overwrites)."""
    if model == "valence":
        for c in ("text_compound", "title_compound"):
            if c in df.columns:
                return df.withColumn("sentiment", bucket(c, VALENCE_BINS))
    else:
        for c in ("text_polarity", "title_polarity"):
            if c in df.columns:
                return df.withColumn("sentiment", bucket(c, POLARITY_BINS))
    return df


def comment_sentiment(posts: DataFrame, id_col: str, lexicon: DataFrame,
                      comments: str = "comments", flat: bool = False,
                      model: str = "valence") -> DataFrame:
    """Scores of every comment (``model``: the four valence scores, or ``polarity`` and
    ``subjectivity``), written into the comment structs (``flat=True``: one row per comment
    with its position). Comments are exploded and scored like texts; only the scores are
    regrouped per post, which holds its comments in one array already."""
    if model == "valence":
        names, score = ("neg", "neu", "pos", "compound"), valence_scores
    else:
        names, score = ("polarity", "subjectivity"), polarity_scores
    cols = [f"comment_{s}" for s in names]
    e = posts.select(id_col, F.posexplode(comments).alias("_i", "_c"))
    e = e.select(id_col, "_i", F.col("_c.comment_text").alias("comment_text"))
    sc = score(e, [id_col, "_i"], "comment_text", lexicon, prefix="comment")
    if flat:
        return e.join(sc, [id_col, "_i"], "left").na.fill(0.0, subset=cols).select(
            id_col, F.col("_i").alias("pos"), *cols)
    per_post = sc.groupBy(id_col).agg(F.map_from_entries(F.collect_list(
        F.struct("_i", F.struct(*cols).alias("v")))).alias("_scores"))
    zero = F.struct(*[F.lit(0.0).alias(c) for c in cols])

    def scored(c, i):
        v = F.coalesce(F.try_element_at("_scores", i), zero)
        for name in cols:
            c = c.withField(name, v[name])
        return c
    return (posts.join(per_post, id_col, "left")
            .withColumn(comments, F.transform(comments, scored)).drop("_scores"))


def daily_sentiment(df: DataFrame, ts: str, score: str, by: Sequence[str]) -> DataFrame:
    """Per group and day: mean score and message volume (the dashboard's input shape)."""
    return (df.groupBy(*by, F.to_date(ts).alias("date"))
              .agg(F.avg(score).alias("sentiment_score"), F.count(F.lit(1)).alias("volume")))


def keyword_tag(df: DataFrame, id_col: str, text: str, terms: DataFrame) -> DataFrame:
    """(id, term) for every term whose tokens all occur in the text (token-set
    containment); a text matched by two terms gives two rows.

    Distinct tokens per text are exploded and equi-joined to the term-token table, which the
    planner broadcasts when it is small; only matching (id, term, token) rows continue to a
    per-(id, term) count compared with the term's size.
    """
    tt = terms.select("term", F.lower("token").alias("token")).distinct()
    # the size of a term is a window over its own tokens
    tt = tt.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy("term")))
    d = df.select(id_col, F.explode(F.array_distinct(tokens(text))).alias("token"))
    hits = d.join(tt, "token")
    g = hits.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("_n"), F.max("_k").alias("_k"))
    return g.where(F.col("_n") == F.col("_k")).select(id_col, F.col("term").alias("event_type"))
