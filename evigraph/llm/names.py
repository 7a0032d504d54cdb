"""Variant spellings of names of people and organisations, by noisy-channel attribution."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..common import node_type, norm_id, spread
from ..session import materialise
from .components import group_ids

# Log-likelihoods of the channel for one event each, and what a name of its own costs.
TYPO, NICKNAME, INITIAL, ACRONYM, ABBREVIATION, MIDDLE = -4.5, -1.5, -2.0, -2.0, -1.0, -0.5
NEW_FULL, NEW_SHORT = -11.5, -8.0
#: Share of all names from which a given name or a word counts as established, and the least count.
ESTABLISHED_SHARE, ESTABLISHED_LEAST = {"person": 0.0005, "organisation": 0.004}, 3
#: A word is read as a misspelling of a near one from so many times its count on, however often it occurs.
FAR_MORE = 8
#: Share of the posterior that the best reading of an initial or an acronym must have.
CLEAR = 0.5

# Titles, particles, suffixes.
TITLES = set("mr mrs ms miss mx dr prof professor sir dame lord lady rev fr hon capt captain col colonel lt lieutenant maj major gen general sgt sergeant cpl pvt adm admiral cmdr commander det insp officer agent".split())
PARTICLES = set("van von de der den del della di da la le du dos das ter ten al el bin ibn".split())
SUFFIXES = set("jr sr ii iii iv phd md esq".split())
# English short forms of given names.
NICKNAMES = {
    "abigail": "abby abbie gail", "albert": "al bert", "alexander": "alex al sandy xander", "alfred": "alf fred", "andrew": "andy drew", "anthony": "tony", "arthur": "art",
    "barbara": "barb babs", "benjamin": "ben benny", "catherine": "cathy kate cat", "charles": "charlie chuck", "christopher": "chris kit topher", "daniel": "dan danny",
    "david": "dave davy", "deborah": "deb debbie debby", "donald": "don donny", "dorothy": "dot dottie", "edward": "ed eddie ted ned", "elizabeth": "liz beth betty eliza lizzie libby lisa",
    "eugene": "gene", "francisco": "paco pancho cisco frank", "francis": "frank", "frederick": "fred freddie freddy", "gerald": "jerry gerry", "gregory": "greg", "harold": "hal harry", "henry": "hank harry",
    "isabel": "bella izzy isa", "jacob": "jake", "james": "jim jimmy jamie", "jennifer": "jen jenny", "johannes": "hans johan", "john": "jack johnny", "jonathan": "jon jonny", "joseph": "joe joey",
    "joshua": "josh", "katherine": "kate kathy katie kat kitty", "kenneth": "ken kenny", "lawrence": "larry laurie", "leonard": "len lenny leo", "margaret": "maggie meg peggy marge margie greta",
    "matthew": "matt", "michael": "mike mick mickey", "nathaniel": "nate nat", "nicholas": "nick nicky", "pamela": "pam", "patricia": "pat patty tricia trish", "patrick": "pat paddy", "peter": "pete",
    "philip": "phil", "raymond": "ray", "rebecca": "becky becca", "richard": "dick rick rich richie", "robert": "bob bobby rob bert", "ronald": "ron ronnie", "samuel": "sam sammy", "stanley": "stan",
    "stephen": "steve stevie", "steven": "steve", "susan": "sue susie suzy", "theodore": "theo ted teddy", "thomas": "tom tommy", "timothy": "tim", "victoria": "vicky vicki tori", "vincent": "vince", "walter": "walt", "william": "bill billy will willy liam",
}
FORMAL: dict[str, set[str]] = {}
for _formal, _short in NICKNAMES.items():
    for _s in _short.split():
        FORMAL.setdefault(_s, set()).add(_formal)
# Words without weight in names of bodies, legal forms, common abbreviations.
EMPTY = set("the of for and de la des du et und der hq headquarters".split())
LEGAL = set("inc incorporated ltd limited llc plc gmbh ev ag sa corp. co".split())
SHORT_WORDS = {
    "obs": "observation", "univ": "university", "uni": "university", "dept": "department", "dep": "department", "intl": "international", "natl": "national", "inst": "institute", "instit": "institute",
    "bur": "bureau", "found": "foundation", "fdn": "foundation", "fndn": "foundation", "corp": "corporation", "soc": "society", "atmos": "atmospheric", "comm": "committee", "cttee": "committee", "cte": "committee",
    "assn": "association", "assoc": "association", "lab": "laboratory", "labs": "laboratory", "res": "research", "rsch": "research", "grp": "group", "govt": "government", "mgmt": "management", "centre": "center", "ctr": "center",
}
_OCR = str.maketrans("0135", "oles")


def fold(s: str) -> str:
    """Case, accents, kinds of blanks, quotes and dashes folded."""
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).casefold()
    s = re.sub("[‘’ʼ`´]", "'", s)
    s = re.sub("[‐-―]", "-", s)
    return " ".join(re.sub('[“”„«»]', '"', s).split())


def ocr(token: str) -> str:
    """A token with letters, as a scanner's usual mistakes leave it on either side."""
    if any(c.isalpha() for c in token):
        token = token.translate(_OCR)
    return token.replace("rn", "m").replace("vv", "w")


def readings(s: str) -> list[str]:
    """s as it is, with cl read as d, with ph read as f, and with both."""
    return [s, s.replace("cl", "d"), s.replace("ph", "f"), s.replace("cl", "d").replace("ph", "f")]


def distance(a: str, b: str, most: int) -> int:
    """edits, with cl read as d and ph as f where that is nearer."""
    return min(edits(x, y, most) for x, y in dict.fromkeys(zip(readings(a), readings(b), strict=True)))


def given_name(token: str, established: frozenset[str]) -> str:
    """A given name; one that nobody has is read as a scanner's mistake where that makes a known one."""
    known = lambda t: t in established or t in FORMAL or t in NICKNAMES
    if known(token) or len(token) == 1:
        return token
    digits = token.translate(_OCR)
    for a, b in (("", ""), ("rn", "m"), ("vv", "w"), ("cl", "d"), ("m", "rn"), ("d", "cl")):
        if known(t := digits.replace(a, b) if a else digits):
            return t
    return token


def parse_person(name: str, established: frozenset[str] = frozenset(), own: frozenset[str] | None = None) -> dict:
    """given, middle (a letter or ''), surname of a name in any usual order.

    Titles, nicknames in quotes or brackets, particles before the surname and suffixes are
    taken off. established: given names by which a surname in front is known; own: those of
    them that are no misspellings (see own_words).
    """
    s = re.sub(r'"[^"]*"|\([^)]*\)', " ", fold(name))
    parts = [p.strip() for p in s.split(",")]
    suffix, kept = "", []
    for p in parts:
        bare = p.replace(".", "")
        if bare in SUFFIXES:
            suffix = bare
        elif bare:
            kept.append(p)
    turned = len(kept) == 2
    words = (kept[1] + " " + kept[0] if turned else " ".join(kept)).split()
    tokens = [w for w in (x.strip(".'") for w in words for x in re.split(r"(?<=\.)(?=\w)", w)) if w]
    while len(tokens) > 1 and tokens[0] in TITLES:
        tokens = tokens[1:]
    if len(tokens) > 1 and tokens[-1] in SUFFIXES:
        suffix, tokens = tokens[-1], tokens[:-1]
    known = lambda t: t in established or t in FORMAL or t in NICKNAMES
    if not turned and len(tokens) > 1:
        lead = 0
        while lead < len(tokens) - 2 and tokens[lead] in PARTICLES:
            lead += 1
        rest = tokens[lead + 1 :]
        given_behind = not known(tokens[0]) and bool(rest) and known(rest[0]) and (len(rest) == 1 or len(rest[-1]) == 1)
        surname_first = (lead or len(tokens[0]) > 1) and (lead or len(tokens[-1]) == 1 or given_behind)
        if surname_first and rest:
            tokens = rest + tokens[lead : lead + 1]
    near_particle = lambda t: t in PARTICLES or (len(t) in (2, 3, 4) and sorted(t) in (sorted("van"), sorted("vaan"), sorted("vvan"), sorted("vann")))
    if len(tokens) < 2:
        return {"given": "", "middle": "", "surname": tokens[0] if tokens else "", "suffix": suffix}
    middle = [t for t in tokens[1:-1] if not near_particle(t)]
    return {"given": given_name(tokens[0], established if own is None else own), "middle": middle[0][:1] if middle else "", "surname": ocr(tokens[-1]), "suffix": suffix}


def parse_body(name: str, established: frozenset[str] = frozenset()) -> dict:
    """tokens (place first, weightless words and legal forms left out, abbreviations spelled out) and acronym."""
    s = re.sub(r"\([^)]*\)", " ", fold(name)).replace("&", " and ").replace("+", " and ")
    s = re.sub(r"\be\.\s?v\b\.?", "ev", s)
    clean = lambda p: [t for t in (re.sub(r"['.]", "", w) for w in re.split(r"[\s\-/_]+", p)) if t and t not in LEGAL - {"corp."}]
    parts = [p for p in (clean(x) for x in s.split(",")) if p]
    tokens = (parts[1] + parts[0] if len(parts) == 2 else [t for p in parts for t in p])
    tokens = [SHORT_WORDS.get(t, t) for t in tokens]
    tokens = [t if t.isdigit() else ocr(t) for t in tokens if t not in EMPTY]
    acronym = tokens[1] if len(tokens) == 2 and 2 <= len(tokens[1]) <= 8 and tokens[1].isalpha() and tokens[1] not in established else ""
    return {"tokens": tokens, "acronym": acronym}


def edits(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap neighbours) between a and b; most + 1 if there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                new[j] = min(new[j], before[j - 2] + 1)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


def _most(token: str) -> int:
    return 0 if len(token) < 4 else 1 if len(token) < 8 else 2


def _deletes2(s: str) -> set[str]:
    """The readings of s with up to two letters left out: any two words that distance() puts
    within two edits share one of these."""
    out = set(readings(s))
    for _ in range(2):
        out |= {x[:i] + x[i + 1 :] for x in out if len(x) > 1 for i in range(len(x))}
    return out


def own_words(counts: dict[str, int], kind: str) -> frozenset[str]:
    """Of the established words those that are words of their own: no near one is FAR_MORE times
    as frequent. A ratio of counts, so the size of the table doesn't matter."""
    index: dict[str, set[str]] = {}
    for w in counts:
        for d in _deletes2(ocr(w)):
            index.setdefault(d, set()).add(w)
    fixed = lambda w: kind == "person" and (w in FORMAL or w in NICKNAMES)
    near = lambda w: {x for d in _deletes2(ocr(w)) for x in index[d] if counts[x] >= FAR_MORE * counts[w]}
    return frozenset(w for w in counts if fixed(w) or not any(distance(ocr(w), ocr(x), _most(x)) <= _most(x) for x in near(w)))


def person_channel(v: dict, c: dict, established: frozenset[str]) -> float | None:
    """The log-likelihood that a person called c is written v; None if it can't be."""
    score = 0.0
    d = distance(v["surname"], c["surname"], _most(c["surname"]))
    if d > _most(c["surname"]) or (v["suffix"] and c["suffix"] and v["suffix"] != c["suffix"]):
        return None
    score += d * TYPO
    if v["middle"] and c["middle"] and v["middle"] != c["middle"]:
        return None
    score += MIDDLE * (bool(v["middle"]) != bool(c["middle"]))
    a, b = v["given"], c["given"]
    if a == b:
        return score
    if len(a) == 1 or len(b) == 1:
        long, short = (b, a) if len(a) == 1 else (a, b)
        names = {long} | FORMAL.get(long, set())
        return score + INITIAL if any(n.startswith(short) for n in names) else None
    fa, fb = FORMAL.get(a, set()) | {a}, FORMAL.get(b, set()) | {b}
    if fa & fb:
        return score + NICKNAME
    if all(x in established or x in FORMAL or x in NICKNAMES for x in (a, b)):
        return None  # two names that people have are no typos of each other
    d = distance(ocr(a), ocr(b), _most(b))
    if d > _most(b):  # a typo in a nickname or of one
        for x, y in ((a, b), (b, a)):
            short = [n for n in NICKNAMES.get(x, "").split() if len(n) > 3 and edits(n, y, 1) == 1]
            if short:
                return score + NICKNAME + TYPO
        return None
    return score + d * TYPO


def _initials(tokens: list[str]) -> str:
    return "".join(t[0] for t in tokens if not t.isdigit())


def body_channel(v: dict, c: dict, established: frozenset[str]) -> float | None:
    """The log-likelihood that a body called c is written v; None if it can't be."""
    a, b = v["tokens"], c["tokens"]
    if not a or not b:
        return None
    if v["acronym"] and not c["acronym"]:
        d = distance(a[0], b[0], _most(b[0]))
        return None if d > _most(b[0]) or v["acronym"] != _initials(b[1:]) or len(b) < 3 else d * TYPO + ACRONYM
    if len(a) != len(b) or sorted(x for x in a if x.isdigit()) != sorted(x for x in b if x.isdigit()):
        return None
    score, left = 0.0, list(b)
    unmatched = []
    for x in a:
        if x in left:
            left.remove(x)
        else:
            unmatched.append(x)
    for x in unmatched:
        if x.isdigit():
            return None
        best = None
        for y in left:
            if y.isdigit() or (x in established and y in established):
                continue
            d = distance(x, y, _most(y))
            cost = d * TYPO if d <= _most(y) else None
            if cost is None and len(x) >= 3 and len(x) < len(y) and x[0] == y[0] and _inside(x, y) and y in established:
                cost = ABBREVIATION
            if cost is not None and (best is None or cost > best[0]):
                best = (cost, y)
        if best is None:
            return None
        score += best[0]
        left.remove(best[1])
    return score


def _inside(x: str, y: str) -> bool:
    at = iter(y)
    return all(c in at for c in x)


def starts(given: str) -> set[str]:
    """Letters of which two given names within reach of the channel share at least one: the first
    three of each reading, since two edits leave one of them among the other's first three."""
    names = {given} | FORMAL.get(given, set()) | {n for n in NICKNAMES.get(given, "").split() if len(n) > 3}
    return {c for n in names for x in (n, ocr(n)) for r in readings(x) for c in r[:3]}


def block_keys(kind: str, p: dict) -> set[tuple[str, str]]:
    """(word, rest): two spellings are compared if they share a rest and their words are equal or
    near (see near_words).

    People: the surname, and a letter of starts(). Bodies: the place, and the numbers with the
    initials of the other words, up to two of them left out but one kept; a body of two words
    also has its second word, with the place less up to two letters. What the channel would link
    and this doesn't bring together: bodies of more words whose first one differs by more than
    edits, or of which more than two initials, or all, differ.
    """
    if kind == "person":
        return {(p["surname"], s) for s in starts(p["given"])} if p["given"] else set()
    tokens = p["tokens"]
    if len(tokens) < 2:
        return set()
    numbers = "#".join(sorted(t for t in tokens if t.isdigit()))
    signs = {"".join(sorted(p["acronym"] or _initials(tokens[1:])))}
    for _ in range(2):
        signs |= {x[:i] + x[i + 1 :] for x in signs if len(x) > 1 for i in range(len(x))}
    second = {(tokens[1], f"{d}~{numbers}") for d in _deletes2(tokens[0])} if len(tokens) == 2 and not p["acronym"] else set()
    return {(tokens[0], f"{s}|{numbers}") for s in signs} | second


def near_words(words: DataFrame) -> DataFrame:
    """(kind, word, near): different words within the channel's edits of one another, both ways,
    and each word with itself. Lossless: near words share one of _deletes2()."""
    @F.pandas_udf("array<string>")
    def deletes(word: pd.Series) -> pd.Series:
        return word.map(lambda x: sorted(_deletes2(x)))

    @F.pandas_udf("boolean")
    def is_near(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([distance(x, y, m) <= m for x, y in zip(a, b, strict=True) for m in (max(_most(x), _most(y)),)], dtype=bool)

    d = materialise(words.select("kind", "word", F.explode(deletes("word")).alias("d")), "deletes")
    pairs = d.join(d.select("kind", F.col("word").alias("near"), "d"), ["kind", "d"]).where("word < near").select("kind", "word", "near").distinct()
    near = materialise(spread(pairs).where(is_near("word", "near")), "near_words")
    return near.unionByName(near.select("kind", F.col("near").alias("word"), F.col("word").alias("near"))).unionByName(words.select("kind", "word", F.col("word").alias("near")))


_PARSED = "struct<key:string,short:boolean,weight:int,given:string,middle:string,surname:string,suffix:string,tokens:array<string>,acronym:string,blocks:array<struct<word:string,rest:string>>>"

_COLUMNS = re.findall(r"(\w+):", re.sub(r"array<struct<.*?>>", "array", _PARSED[len("struct<") : -1]))


def _parsed(kind: str, name: str, established: frozenset[str], own: frozenset[str]) -> dict | None:
    if kind == "person":
        p = parse_person(name, established, own)
        key = "|".join((p["given"], p["middle"], p["surname"], p["suffix"]))
        ok, short = bool(p["surname"]), len(p["given"]) == 1
        out = {"key": key, "short": short, "weight": len(p["given"]) + 2 * bool(p["middle"]), **p, "tokens": None, "acronym": None}
    else:
        p = parse_body(name, established)
        ok, short = bool(p["tokens"]), bool(p["acronym"])
        out = {"key": " ".join(p["tokens"]), "short": short, "weight": sum(map(len, p["tokens"])), "given": None, "middle": None, "surname": None, "suffix": None, **p}
    return out | {"blocks": [{"word": w, "rest": r} for w, r in sorted(block_keys(kind, p))]} if ok else None


def _first_words(name: str, kind: str) -> list[str]:
    if kind == "person":
        p = parse_person(name)
        return [p["given"]] if len(p["given"]) > 1 else []
    return sorted(set(parse_body(name)["tokens"]))


def spellings(nodes: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, frozenset[str]]]:
    """(spelling classes, node to class, established words of their own by type) of the live people and bodies.

    A class are the spellings that differ only in case, accents, blanks, order, titles and
    the like. Names are parsed once for each distinct spelling.
    """
    kinds = ("person", "organisation")
    live = nodes.where(F.col("retired_at").isNull()).select(norm_id("id").alias("id"), node_type("node_type").alias("kind"), "name")
    live = live.where(F.col("id").isNotNull() & F.col("kind").isin(*kinds) & (F.trim("name") != "")).distinct()
    names = materialise(live.groupBy("kind", "name").agg(F.count("*").alias("uses")), "names")

    @F.pandas_udf("array<string>")
    def first_words(kind: pd.Series, name: pd.Series) -> pd.Series:
        return pd.Series([_first_words(n, k) for k, n in zip(kind, name, strict=True)])

    # at most (words of a name / share) rows of each type come to the driver
    totals = {r["kind"]: r["n"] for r in names.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    words = names.select("kind", F.explode(first_words("kind", "name")).alias("word")).groupBy("kind", "word").agg(F.count("*").alias("n"))
    floor = F.lit(None).cast("double")
    for k in kinds:
        floor = F.when(F.col("kind") == k, F.lit(max(ESTABLISHED_LEAST, ESTABLISHED_SHARE[k] * totals.get(k, 0)))).otherwise(floor)
    rows = words.where(F.col("n") >= floor).collect()
    established = {k: frozenset(r["word"] for r in rows if r["kind"] == k) for k in kinds}
    own = {k: own_words({r["word"]: r["n"] for r in rows if r["kind"] == k}, k) for k in kinds}
    sent = nodes.sparkSession.sparkContext.broadcast((established, own))

    @F.pandas_udf(_PARSED)
    def parse(kind: pd.Series, name: pd.Series) -> pd.DataFrame:
        out = [_parsed(k, n, sent.value[0][k], sent.value[1][k]) or {} for k, n in zip(kind, name, strict=True)]
        return pd.DataFrame({c: [r.get(c) for r in out] for c in _COLUMNS})

    parsed = spread(names).withColumn("p", parse("kind", "name")).select("kind", "name", "uses", "p.*").where("key IS NOT NULL")
    parsed = materialise(parsed, "parsed")
    classes = parsed.groupBy("kind", "key").agg(F.sum("uses").alias("uses"), *[F.first(c).alias(c) for c in ("short", "weight", "given", "middle", "surname", "suffix", "tokens", "acronym", "blocks")])
    of_node = live.join(parsed.select("kind", "name", "key"), ["kind", "name"]).select("id", "kind", "key")
    return materialise(classes, "classes"), materialise(of_node, "members"), own


def attributions(classes: DataFrame, established: dict[str, frozenset[str]]) -> DataFrame:
    """(kind, key, to): each spelling class that is a variant, and the class it is attributed to.

    Candidates are ranked: spelled-out before shortened, then by frequency, then the fuller
    spelling; the channel of two classes that share a block runs from the higher to the lower.
    posterior = frequency prior x channel likelihood. Both weigh the uses of one spelling for each
    use of the other: the prior where the asked one is more frequent, the channel where the asking
    one is; so a table with every name ten times as often has the same links. A class goes to
    its maximum, unless a name of its own is likelier; of two spellings about as frequent that
    differ by a typo either may be the true one, so both ask. A shortened one (initial, acronym) weighs whole
    entities, so that an entity's other spellings add to it, and needs a clear majority.
    """
    fields = ["key", "uses", "short", "weight", "given", "middle", "surname", "suffix", "tokens", "acronym"]
    rank = F.struct(F.col("short"), -F.col("uses"), -F.col("weight"), F.col("key"))
    keyed = materialise(classes.select("kind", "key", rank.alias("rank"), F.explode("blocks").alias("b")).select("kind", "key", "rank", "b.word", "b.rest"), "blocks")
    near = near_words(keyed.select("kind", "word").distinct())
    asks = keyed.join(near, ["kind", "word"]).select("kind", F.col("near").alias("word"), "rest", F.col("key").alias("vk"), "rank")
    pairs = asks.join(keyed.select("kind", "word", "rest", F.col("key").alias("ck"), F.col("rank").alias("c_rank")), ["kind", "word", "rest"]).where("c_rank < rank").select("kind", "vk", "ck").distinct()
    struct = classes.select("kind", "key", F.struct(*fields).alias("s"))
    pairs = pairs.join(struct.select("kind", F.col("key").alias("vk"), F.col("s").alias("v")), ["kind", "vk"]).join(struct.select("kind", F.col("key").alias("ck"), F.col("s").alias("c")), ["kind", "ck"])
    sent = classes.sparkSession.sparkContext.broadcast(established)
    channel = {"person": person_channel, "organisation": body_channel}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = lambda r: {k: list(x) if k == "tokens" and x is not None else x for k, x in (r if isinstance(r, dict) else r.asDict()).items()}
        for b in batches:
            out = []
            for kind, v, c in zip(b["kind"], b["v"], b["c"], strict=True):
                v, c = plain(v), plain(c)
                if v["short"] and c["short"] and (v["middle"] != c["middle"] or v["given"] != c["given"]):
                    continue
                s = channel[kind](v, c, sent.value[kind])
                if s is not None:
                    out.append((kind, v["key"], c["key"], v["short"], c["short"], int(v["uses"]), int(c["uses"]), s))
            yield pd.DataFrame(out, columns=["kind", "key", "to", "short", "to_short", "uses", "to_uses", "channel"])

    scored = pairs.select("kind", "v", "c").repartition("kind", F.xxhash64("v.key")).mapInPandas(score, "kind string, key string, to string, short boolean, to_short boolean, uses long, to_uses long, channel double")
    scored = materialise(scored, "scored")
    ratio = F.col("uses") / F.col("to_uses")
    posterior = F.log(F.greatest(F.lit(1.0), 1 / ratio)) + F.col("channel") * (1 + F.log(F.greatest(F.lit(1.0), ratio)))
    # between spellings of one kind either may be the variant: each asks for its own best
    same = scored.where("short = to_short").select("kind", "key", "to", "short", "uses", "to_uses", "channel")
    same = same.unionByName(same.select("kind", F.col("to").alias("key"), F.col("key").alias("to"), "short", F.col("to_uses").alias("uses"), F.col("uses").alias("to_uses"), "channel")).withColumn("score", posterior)
    best = same.groupBy("kind", "key").agg(F.max_by(F.struct("to", "score", "short"), F.struct("score", "to_uses", "to")).alias("b"))
    own = F.when(F.col("b.short"), F.lit(NEW_SHORT)).otherwise(F.lit(NEW_FULL))
    spelled = materialise(best.where(F.col("b.score") > own).select("kind", "key", "b.to"), "spelled")
    # entities of spelled-out classes, for the shortened ones
    full = classes.where("NOT short")
    node = lambda k: F.concat_ws("\u001f", "kind", k)
    entity = group_ids(full.select(node("key").alias("id")), spelled.join(full.select("kind", "key"), ["kind", "key"], "left_semi").select(node("key").alias("a"), node("to").alias("b")))
    weight = full.select("kind", F.col("key").alias("to"), node("key").alias("id"), "uses").join(entity, "id")
    total = weight.groupBy("group_id").agg(F.sum("uses").alias("entity_uses"))
    short = scored.where("short AND NOT to_short").join(weight.select("kind", "to", "group_id"), ["kind", "to"])
    short = short.groupBy("kind", "key", "group_id").agg(F.max_by("to", F.struct("channel", "to_uses", "to")).alias("to"), F.max("channel").alias("channel"), F.max("uses").alias("uses")).join(total, "group_id")
    score_s = F.log("entity_uses") + F.col("channel")
    w = W.partitionBy("kind", "key")
    share = F.exp("score") / F.sum(F.exp("score")).over(w)
    chosen = short.withColumn("score", score_s).withColumn("share", share).where((F.col("score") > NEW_SHORT) & (F.col("share") > CLEAR))
    return spelled.select("kind", "key", "to").unionByName(chosen.select("kind", "key", "to"))


def name_groups(nodes: DataFrame) -> DataFrame:
    """(id, kind, group_id) of every live person and organisation with a name.

    Retired nodes, other types, null and blank names are left out; repeated rows count once.
    """
    classes, members, established = spellings(nodes)
    links = attributions(classes, established)
    node = lambda k: F.concat_ws("\u001f", "kind", k)
    groups = group_ids(classes.select(node("key").alias("id")), links.select(node("key").alias("a"), node("to").alias("b")))
    return members.withColumn("_c", node("key")).join(groups.withColumnRenamed("id", "_c"), "_c").select("id", "kind", "group_id").distinct()


def same_entity_pairs(groups: DataFrame, salts: int = 8) -> DataFrame:
    """(node_a, node_b), node_a < node_b: all pairs inside the groups, as the result is defined.

    One side is spread over salts, so that a group's pairs are made by several tasks.
    """
    a = groups.select("group_id", F.col("id").alias("node_a")).withColumn("_s", F.pmod(F.xxhash64("node_a"), F.lit(salts)).cast("int"))
    b = groups.select("group_id", F.col("id").alias("node_b")).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b, ["group_id", "_s"]).where("node_a < node_b").select("node_a", "node_b").distinct()
