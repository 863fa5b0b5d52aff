"""Text operators: gated label-correction rules (L1, L11) and dictionary
matching with longest-match suppression (J11, J12).

Regexes use Java's ``(?iU)`` flags: case-insensitive with Unicode word
characters and boundaries, the behaviour of Python's ``re`` on text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.functions.columns import col_of, fill_once, word_pattern

# The rule vocabulary, as regex alternations
# matched as whole words, case-insensitively.
RULE_PATTERNS = {
    "rate": r"RBI|Fed|Federal Reserve|repo rate|interest rate|rate",
    "hold": r"hold(s|ing)?",
    "hike": r"hik(e|es|ed)",
    "cut": r"cut(s)?",
    "rally": r"rall(y|ies|ied)|gains?|climbs?|surges?|jumps?|soars?|rises?|rose|advance[sd]?",
    "fall": r"falls?|fell|slides?|tanks?|plunges?|drops?|slumps?|sinks?|tumbles?|declines?",
    "preview": r"weekly wrap|what to expect|things to know|week ahead|day ahead|top stories",
}

# The rule cascade, first firing rule wins.
# (rule name, patterns required, patterns that must be absent,
#  labels the rule applies to, new label)
LABEL_RULES = [
    ("rate_hold", ["rate", "hold"], [], ["negative"], "neutral"),
    ("rate_hike", ["rate", "hike"], [], ["positive"], "negative"),
    ("rate_cut", ["rate", "cut"], [], ["negative"], "positive"),
    ("market_rally", ["rally"], ["fall"], ["neutral"], "positive"),
    ("market_fall", ["fall"], ["rally"], ["neutral"], "negative"),
    ("preview_digest", ["preview"], ["rate", "rally", "fall"], ["positive", "negative"], "neutral"),
]


def rule_flags(text: Column, patterns: dict[str, str] = RULE_PATTERNS) -> dict[str, Column]:
    return {k: text.rlike(word_pattern(p)) for k, p in patterns.items()}


def rule_outcome(text, label, rules=LABEL_RULES, patterns=RULE_PATTERNS) -> Column:
    """F16: struct(label, rule) of the first rule that fires on (text, label);
    (label, NULL) when none fires. One CASE WHEN, each pattern tested once
    per row (the flags are shared sub-expressions)."""
    text, label = col_of(text), col_of(label)
    flags = rule_flags(text, patterns)
    out = F.struct(label.alias("label"), F.lit(None).cast("string").alias("rule"))
    for name, need, absent, applies, new in reversed(rules):
        cond = label.isin(applies)
        for p in need:
            cond = cond & flags[p]
        for p in absent:
            cond = cond & ~flags[p]
        out = F.when(cond, F.struct(F.lit(new).alias("label"), F.lit(name).alias("rule"))).otherwise(out)
    return out


def apply_label_rules(df: DataFrame, text: str = "headline", label: str = "sentiment_label",
                      original: str = "sentiment_label_original") -> DataFrame:
    """L1: correct ``label`` by the rule cascade. Rules read the original
    label (kept once in ``original``), so running twice changes nothing."""
    if original not in df.columns:
        df = df.withColumn(original, F.lit(None).cast("string"))
    orig = fill_once(original, label)
    res = rule_outcome(F.col(text), orig)
    return (df.withColumn(original, orig)
            .withColumn("_r", res)
            .withColumn(label, F.col("_r.label"))
            .withColumn("rule", F.col("_r.rule"))
            .drop("_r"))


def correction_log(df: DataFrame, id_col: str = "id", label: str = "sentiment_label",
                   original: str = "sentiment_label_original") -> DataFrame:
    """Rows a rule changed (``rule`` set and label differs)."""
    return df.where(F.col("rule").isNotNull() & (F.col(label) != F.col(original))) \
        .select(id_col, "rule", F.col(original).alias("original_label"), F.col(label).alias("corrected_label"))


def _first_word(term: Column) -> Column:
    return F.lower(F.regexp_extract(term, r"(?U)\w+", 0))


def _spans(text: Column, candidates: Column, term_col: str) -> Column:
    """The candidate structs whose term occurs in ``text`` as a whole word,
    with the first occurrence's 1-based start and exclusive end."""
    def located(c: Column) -> Column:
        pat = F.concat(F.lit(r"(?iU)\b\Q"), F.replace(c[term_col], F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E\b"))
        start = F.regexp_instr(text, pat)
        return F.struct(c.alias("term"), start.alias("start"), (start + F.length(c[term_col])).alias("end"))
    return F.filter(F.transform(F.coalesce(candidates, F.array()), located), lambda m: m["start"] > 0)


def with_matches(texts: DataFrame, id_col: str, text_col: str, dim: DataFrame, term_col: str = "name",
                 out: str = "matches") -> DataFrame:
    """Every text (all its columns) with the array of dictionary terms
    found in it as whole words, case-insensitively, first occurrence only:
    struct(term struct<dictionary columns>, start, end).

    Candidates are the terms whose first word is one of the text's word
    tokens: distinct (id, token) pairs meet the dictionary by an equi-join
    (Catalyst broadcasts a dictionary that it knows to be small and shuffles
    otherwise), and the hits, a few per text, are gathered per id. Only
    candidates run the exact regex, in the text's own row. Terms must
    contain a word character; ids must be unique.
    """
    d = dim.select(F.struct(*dim.columns).alias("_term"), _first_word(F.col(term_col)).alias("_w")).where(F.col("_w") != "")
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"(?U)\w+"), 0))
    hits = (texts.select(id_col, F.explode(tokens).alias("_w")).join(d, "_w")
            .groupBy(id_col).agg(F.collect_list("_term").alias("_terms")))
    return (texts.join(hits, id_col, "left").select(*texts.columns, "_terms")
            .withColumn(out, _spans(F.col(text_col), F.col("_terms"), term_col)).drop("_terms"))


def match_terms(texts: DataFrame, id_col: str, text_col: str, dim: DataFrame, term_col: str = "name") -> DataFrame:
    """J11 as rows (id, dictionary columns..., start, end)."""
    m = with_matches(texts.select(id_col, text_col), id_col, text_col, dim, term_col)
    return m.select(id_col, F.explode("matches").alias("_m")).select(id_col, "_m.term.*", "_m.start", "_m.end")


def drop_contained(matches: Column, tie: str) -> Column:
    """J12 on a text's array of matches: see ``suppress_contained``."""
    def inside(a: Column, b: Column) -> Column:
        shorter = (b["end"] - b["start"]) > (a["end"] - a["start"])
        return (b["start"] <= a["start"]) & (b["end"] >= a["end"]) & (shorter | (b["term"][tie] < a["term"][tie]))
    return F.filter(matches, lambda a: ~F.exists(matches, lambda b: inside(a, b)))


def suppress_contained(matches: DataFrame, id_col: str, tie: str) -> DataFrame:
    """Drop a match whose span lies inside another match's span in the
    same text (the longer match wins; equal spans keep the smallest ``tie``).

    A match is contained iff some match ordered before it by (start asc,
    end desc, tie asc) ends at or after its end: a running maximum per text,
    so no pairs of matches are formed. Matches per text are bounded by the
    dictionary size.
    """
    w = Window.partitionBy(id_col).orderBy(F.col("start").asc(), F.col("end").desc(), F.col(tie).asc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    prev_end = F.max("end").over(w)
    return matches.withColumn("_pe", prev_end).where(F.col("_pe").isNull() | (F.col("_pe") < F.col("end"))) \
        .drop("_pe")
