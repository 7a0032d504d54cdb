"""Text cut off by field limits or broken transfers, by length histograms and ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialise

#: A length is a spike if at least SPIKE_TEXTS different texts of a source have it, a share
#: SPIKE_SHARE of the source's texts, and SPIKE_TIMES as many as the mean of the lengths up to
#: SPIKE_NEAR away on either side.
SPIKE_TEXTS, SPIKE_SHARE, SPIKE_TIMES, SPIKE_NEAR = 4, 0.01, 8.0, 40
#: A line's first word marks a closing line if so large a share of all different texts end
#: with such a line unpunctuated, and so large a share of such lines stands at the end.
CLOSING_SHARE, CLOSING_LAST = 0.001, 0.5

# Marks that software leaves where it cut (at the end of a text), sentence ends
# of several scripts, and what may follow them.
MARKS = r"(?U)(?:\[\s*(?:\.\.\.|…)\s*\]?|\(\s*(?:\.\.\.|…)\s*\)?|[\[(]\s*(?i:continued|cont'd|cont\.|truncated|more|read more|cut|snip)[^\])\n]{0,20}[\])]?|(?i:<\s*(?:truncated|snip|more)\s*/?>))$"
ENDS = ".!?。！？．｡؟۔।॥։።…"
AFTER = "\"'”’»›“‘)]}）」』】*_"


#: What is taken off a text's end before it is looked at.
BLANKS = "".join(chr(c) for c in [*range(33), *range(127, 161), 0xAD, 0x1680, *range(0x2000, 0x2010), *range(0x2028, 0x2030), 0x205F, *range(0x2060, 0x2065), 0x3000, 0xFEFF])
#: Addresses and rules that may stand behind a sentence's end; possessive, so that long runs of
#: blanks and marks cost no backtracking.
BEHIND = r"(?<!\s)(?:\s++(?:https?://\S++|[-=_*~#]{3,}+))++$"


def _ends_in(text: Column, chars: str) -> Column:
    return F.right(text, F.lit(1)).isin(*chars)


def _ended(text: Column) -> Column:
    """Whether a sentence ends there, whatever quotes and brackets follow it."""
    return _ends_in(F.rtrim(text, F.lit(AFTER)), ENDS)


def described(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per non-blank text: its lengths without and with the mark, and how its end looks."""
    d = documents.select(F.col(key).alias("_key"), F.col("source").alias("_source"), F.col("n_chars").cast("bigint").alias("_said"), F.col("text").alias("_text"))
    d = d.withColumn("_body", F.rtrim(F.col("_text"), F.lit(BLANKS))).where(F.length("_body") > 0)
    # patterns run over whole texts, so only where a cheap look says that they may fit
    body, blanks = F.col("_body"), F.lit(BLANKS)
    behind = F.contains(body, F.lit("http")) | _ends_in(body, "-=_*~#")
    d = d.withColumn("_core", F.when(behind, F.regexp_replace("_body", BEHIND, "")).otherwise(body))
    bracket = F.contains(body, F.lit("[")) | F.contains(body, F.lit("(")) | F.contains(body, F.lit("<"))
    d = d.withColumn("_marked", F.when(bracket, body.rlike(MARKS)).otherwise(F.lit(False)))
    x = F.when(F.col("_marked"), F.rtrim(F.regexp_replace("_body", MARKS, ""), blanks)).otherwise(body)
    d = d.withColumn("_unmarked", x)
    three = lambda c: F.endswith(c, F.lit("..."))
    one = lambda c: F.endswith(c, F.lit("…"))
    u = F.col("_unmarked")
    d = d.withColumn("_bare", F.when(three(u), F.rtrim(F.rtrim(u, F.lit(".")), blanks)).when(one(u), F.rtrim(F.left(u, F.length(u) - 1), blanks)).otherwise(u))
    last = F.substring_index(F.translate("_body", "\r", "\n"), "\n", -1)
    return d.select(
        "_key",
        "_source",
        "_said",
        F.xxhash64("_text").alias("_hash"),
        F.length("_text").alias("chars"),
        F.octet_length("_text").alias("bytes"),
        F.length("_bare").alias("bare"),
        F.col("_marked").alias("marked"),
        (three(body) | one(body)).alias("dotted"),
        _ended(F.col("_bare")).alias("bare_ended"),
        F.endswith("_body", F.lit("\ufffd")).alias("broken"),
        _ended(F.col("_core")).alias("ended"),
        F.when(F.endswith(body, F.lit(">")), body.rlike(r"</\s*[A-Za-z][\w:-]*\s*>$")).otherwise(F.lit(False)).alias("tag"),
        F.trim(last).alias("last"),
    )


def _lead(line: Column) -> Column:
    """A line's first word, in lower case, digits masked."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.trim(line), r"(?U)^(\S+)", 1)), r"\d+", "9")


def spikes(d: DataFrame) -> DataFrame:
    """(_source, unit, length, texts): lengths at which too many different texts of a source end.

    unit is chars or bytes of texts without a mark, or bare, the characters before a mark. A source that had several limits
    has several spikes. Copies of a text count once.
    """
    is_marked = F.col("marked") | F.col("dotted")
    unit = lambda u, cond: F.struct(F.lit(u).alias("unit"), F.when(cond, F.col(u).cast("int")).alias("length"))
    units = F.explode(F.array(unit("chars", ~is_marked), unit("bytes", ~is_marked), unit("bare", is_marked)))
    texts = d.groupBy("_source", "_hash").agg(F.first("chars").alias("chars"), F.first("bytes").alias("bytes"), F.first("bare").alias("bare"), F.first("marked").alias("marked"), F.first("dotted").alias("dotted"))
    hist = texts.select("_source", units.alias("u")).select("_source", "u.*").where("length IS NOT NULL").groupBy("_source", "unit", "length").agg(F.count("*").alias("texts"))
    w = W.partitionBy("_source", "unit").orderBy("length")
    near = F.sum("texts").over(w.rangeBetween(-SPIKE_NEAR, SPIKE_NEAR)) - F.sum("texts").over(w.rangeBetween(-1, 1))
    expected = near / F.lit(2.0 * (SPIKE_NEAR - 1))
    share = F.lit(SPIKE_SHARE) * F.sum("texts").over(W.partitionBy("_source", "unit"))
    many = (F.col("texts") >= SPIKE_TEXTS) & ((F.col("unit") == "bare") | (F.col("texts") >= F.col("share")))
    return hist.withColumns({"expected": expected, "share": share}).where(many & (F.col("texts") >= SPIKE_TIMES * F.col("expected"))).drop("expected", "share")


def closing_words(documents: DataFrame, d: DataFrame) -> DataFrame:
    """(lead): first words of lines that close a text without punctuation (signatures, file
    marks), learned from all different texts."""
    distinct = d.groupBy("_hash").agg(F.first("last").alias("last"), F.first("ended").alias("ended"), F.first("tag").alias("tag"), F.first("marked").alias("marked"))
    n = distinct.count()
    at_end = distinct.where(~F.col("ended") & ~F.col("tag") & ~F.col("marked")).groupBy(_lead(F.col("last")).alias("lead")).agg(F.count("*").alias("at_end"))
    at_end = at_end.where(F.col("at_end") >= max(3, CLOSING_SHARE * n))
    lines = documents.select(F.explode(F.split(F.translate("text", "\r", "\n"), "\n")).alias("line")).groupBy(_lead(F.col("line")).alias("lead")).agg(F.count("*").alias("lines"))
    return at_end.join(lines, "lead").where(F.col("at_end") >= CLOSING_LAST * F.col("lines")).select("lead")


def truncated(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, source, cut boolean, reason) of every non-blank text.

    A text is cut if it ends in a mark of cutting or half a character; if it has the length of
    a spike of its source, in characters or bytes, and no terminal punctuation; if more was
    announced (n_chars) than characters and bytes are there; or if it ends without terminal
    punctuation and its last line is no closing line (list item, table row, rule, bracketed
    note, address, closing tag, signature and the like). Dots of omission at the end count as
    a mark where the words before them end no sentence or their length is a spike. Null,
    empty and blank texts have no row, a null source is a source of its own, repeated rows
    give repeated rows.
    """
    d = materialise(described(documents, key), "ends")
    found = spikes(d)
    at = found.select(F.col("_source").alias("s"), "unit", "length")
    for u in ("chars", "bytes", "bare"):
        mine = at.where(F.col("unit") == u).select("s", F.col("length").alias("_l"), F.lit(True).alias(f"at_{u}"))
        d = d.join(mine, F.col("_source").eqNullSafe(F.col("s")) & (F.col(u) == F.col("_l")), "left").drop("s", "_l")
    lead = closing_words(documents, d).select(F.col("lead").alias("_lead"), F.lit(True).alias("closes"))
    d = d.withColumn("_lead", _lead(F.col("last"))).join(lead, "_lead", "left")
    shaped = (
        F.col("last").rlike(r"^(?:[-*•+]\s|\|.*\||[~=_*#+.\-—–]{2,}$|[—–-]{1,2}\s?\S)")
        | F.col("last").rlike(r"^\([^()]*\)$")
        | F.col("last").rlike(r"^\[[^\[\]]*\]$")
        | F.col("last").rlike(r"(?i)^(?:https?://|www\.)\S+$")
        | F.col("tag")
    )
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    reason = (
        F.when(F.col("marked"), "mark")
        .when(F.col("dotted") & (yes("at_bare") | ~F.col("bare_ended")), "mark")
        .when(F.col("broken"), "broken character")
        .when(F.col("ended"), F.when(F.col("_said") > F.greatest("chars", "bytes"), "announced length"))
        .when(yes("at_chars") & ~F.col("tag"), "limit in characters")
        .when(yes("at_bytes") & ~F.col("tag"), "limit in bytes")
        .when(F.col("_said") > F.greatest("chars", "bytes"), "announced length")
        .when(~(shaped | yes("closes")), "open end")
    )
    return d.select(F.col("_key").alias(key), F.col("_source").alias("source"), reason.isNotNull().alias("cut"), reason.alias("reason"))


def truncation_by_source(ends: DataFrame) -> DataFrame:
    """(source, n_texts, n_cut, share_cut) from truncated()."""
    return ends.groupBy("source").agg(F.count("*").alias("n_texts"), F.sum(F.col("cut").cast("int")).alias("n_cut"), F.avg(F.col("cut").cast("int")).alias("share_cut"))
