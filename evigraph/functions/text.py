"""Column expressions on texts, names, dates, hashes: the parts that Catalyst can do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Node types that get written into names, words of document names, months.
TYPE_WORDS = ("person", "organisation", "project", "place", "event", "object", "document", "topic", "concept", "matter")
DOCUMENT_WORDS = (
    "memo memorandum report letter letters article articles paper papers book books brief briefing briefings slide slides document documents disclosure disclosures publication publications "
    "statement testimony affidavit footage recording transcript video photographs photograph bulletin volume evaluation assessment estimate summary findings analysis dossier treaty notes communique"
).split()
NOT_DOCUMENT_WORDS = "system systems programme programmes program programs centre center database network facility service".split()
KNOWN_DOCUMENTS = ("FLIR1", "FLIR-1", "Gimbal", "Go-Fast", "Tic Tac FLIR", "Tic Tac FLIR Video")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
COUNTRIES = {"united kingdom": "UK", "great britain": "UK", "united states": "USA", "united states of america": "USA"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_type_prefix(c: str | Column) -> Column:
    """Without a leading 'topic: ' and the like; a name that is nothing else stays."""
    x = _col(c)
    bare = F.trim(F.regexp_replace(x, rf"(?i)^(?:{'|'.join(TYPE_WORDS)})\s*:\s*", ""))
    return F.when(bare == "", x).otherwise(bare)


def unusable_name(c: str | Column) -> Column:
    """Why a name can't be a node's, null if it can."""
    x = _col(c)
    suffix = rf"(?i)\s*\((?:{'|'.join((*TYPE_WORDS, 'record'))})\)\s*$"
    return F.when(x.rlike(r"(?i)\(redacted\)"), "redacted").when(x.rlike(suffix), "type suffix")


def iso_dates(c: str | Column) -> Column:
    """'14 November 2004' as 2004-11-14 and 'November 2004' as 2004-11."""
    x = _col(c)
    for i, m in enumerate(MONTHS, 1):
        x = F.regexp_replace(x, rf"(?i)\b(\d)\s+{m}\s+(\d{{4}})\b", f"$2-{i:02d}-0$1")
        x = F.regexp_replace(x, rf"(?i)\b(\d\d)\s+{m}\s+(\d{{4}})\b", f"$2-{i:02d}-$1")
        x = F.regexp_replace(x, rf"(?i)\b{m}\s+(\d{{4}})\b", f"$1-{i:02d}")
    return x


def place_country(c: str | Column) -> Column:
    """A place with its country, the part before the first comma, in the short form."""
    x = _col(c)
    head, rest = F.lower(F.trim(F.substring_index(x, ",", 1))), F.regexp_extract(x, r"(?s)^[^,]*(,.*)$", 1)
    out = x
    for k, v in COUNTRIES.items():
        out = F.when(head == k, F.concat(F.lit(v), rest)).otherwise(out)
    return out


def is_description(c: str | Column) -> Column:
    return _col(c).rlike(r"^\s*\[[^\[\]]+\]\s*$")


def is_document_name(c: str | Column) -> Column:
    """Whether a name reads like a document's: a known one, or a document word and no word of an institution."""
    x = _col(c)
    word = lambda ws: x.rlike(rf"(?i)\b(?:{'|'.join(ws)})\b")
    plural = x.rlike(rf"(?i)\b(?:{'|'.join(DOCUMENT_WORDS)})s?\b")
    return x.isin(*KNOWN_DOCUMENTS) | (~word(NOT_DOCUMENT_WORDS) & plural)


def blind_key(c: str | Column) -> Column:
    """Letters a-z and digits in lower case; null where none is left."""
    k = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]", "")
    return F.when(k != "", k)


def declared_acronym(c: str | Column) -> Column:
    a = F.regexp_extract(_col(c), r"\(([A-Z0-9][A-Z0-9.&/-]+)\)\s*$", 1)
    return F.when(a != "", a)


def trailing_acronym(c: str | Column) -> Column:
    """kernel.declared_acronym(): what stands in brackets at the end, in capitals."""
    a = F.upper(F.regexp_extract(_col(c), r"\(([A-Za-z0-9./-]{2,10})\)\s*$", 1))
    return F.when(a != "", a)


def body(c: str | Column) -> Column:
    """A record's text without its front matter and {{annotations}}."""
    x = F.regexp_replace(_col(c), r"(?s)\A---\n.*?\n---\n?", "")
    return F.regexp_replace(x, r"(?s)\{\{.*?\}\}", " ")


def safe_filename(c: str | Column) -> Column:
    """A name as a file's: characters that file systems refuse become '-', at most 200 letters."""
    x = F.trim(F.regexp_replace(F.regexp_replace(_col(c), r'[\\/:*?"<>|#^\[\]\x00-\x1f]', "-"), r"\s+", " "))
    return F.substring(F.when(x == "", "unnamed").otherwise(x), 1, 200)


def has_offset(c: str | Column) -> Column:
    return _col(c).rlike(r"(?i)^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$")


def canonical_utc(c: str | Column) -> Column:
    """A timestamp that carries an offset as yyyy-MM-ddTHH:mm:ssZ in UTC; else null."""
    from ..common import parse_utc

    ts = parse_utc(c)
    seconds = F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(has_offset(c), F.concat(seconds, F.lit("Z")))


def bucket(c: str | Column, n: int = 32) -> Column:
    """The fixed bucket of an id: crc32 of its UTF-8 bytes modulo n."""
    return F.pmod(F.crc32(F.encode(_col(c), "UTF-8")), F.lit(n)).cast("int")


def entailment_ok(label: str, score: str, model: str, premise: str, labels: tuple[str, ...], premises: tuple[str, ...]) -> Column:
    """Whether an entailment block is whole: a known label, a score from 0 to 1, a model, a known premise."""
    parts = [F.col(label).isin(*labels), F.col(score).between(0, 1) & ~F.isnan(score), F.trim(model) != "", F.col(premise).isin(*premises)]
    return reduce(lambda a, b: a & b, [F.coalesce(p, F.lit(False)) for p in parts])


def sigmoid(c: str | Column) -> Column:
    x = F.greatest(F.least(_col(c), F.lit(700.0)), F.lit(-700.0))
    return 1 / (1 + F.exp(-x))
