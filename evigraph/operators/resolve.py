"""Entity resolution: name keys, tiered matching, fuzzy candidates."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..common import spread
from ..functions import kernel, names, text
from ..functions.kernel import ratio_udf, similarity_udf
from ..session import materialise


#: Tasks over which the holders of one word are spread.
SALTS = 8
#: Letters up to which words meet by what is left when letters are dropped; bits of the bitmap of these.
LONGEST, BITS = 15, 1 << 26


def plain_key(c: str | Column) -> Column:
    """A name in lower case with word punctuation and runs of blanks as one blank."""
    x = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), "[-_.]+", " "), r"\s+", " "))


def name_edges(nodes: DataFrame, key: Column | None = None) -> DataFrame:
    """(a, b, score), a < b: pairs of nodes whose names have one key; 0.95, or 0.9 throughout a
    group that spans types."""
    k = nodes.select("id", "node_type", (plain_key("name") if key is None else key).alias("key")).where("key <> ''")
    g = k.groupBy("key").agg(F.countDistinct("node_type").alias("types"), F.count("*").alias("n")).where("n > 1").drop("n")
    k = k.join(g, "key")
    pair = k.select(F.col("id").alias("a"), "key", "types").join(k.select(F.col("id").alias("b"), "key"), "key").where("a < b")
    return pair.select("a", "b", F.when(F.col("types") > 1, F.lit(0.9)).otherwise(F.lit(0.95)).alias("score"))


def _remnants(need: dict[tuple[int, int], int], there: np.ndarray | None = None) -> Callable:
    """A UDF: for each word the hashes of what is left of it, in each way, when it drops letters.

    need: (length of the word, of its partner) -> letters that they have in common. A hash
    stands for these two lengths and the letters left. there: a bitmap (see _bitmap); only
    hashes whose bit is set come out.
    """
    rate = np.random.default_rng(7).integers(1, 2**63, LONGEST + 2, dtype=np.uint64) | np.uint64(1)
    steps: dict[int, list[tuple[int, np.uint64]]] = {}
    for (n, m), common in need.items():
        steps.setdefault(n, []).append((common, np.uint64((min(n, m) * 64 + max(n, m)) * int(rate[-1]) % 2**64)))

    @F.pandas_udf("array<bigint>")
    def keys(t: pd.Series) -> pd.Series:
        words, out = t.tolist(), np.empty(len(t), object)
        by: dict[int, list[int]] = {}
        for i, x in enumerate(words):
            out[i] = np.zeros(0, np.int64)
            by.setdefault(len(x), []).append(i)
        for n, every in by.items():
            for at in range(0, len(every) if n in steps else 0, 512):
                rows = every[at : at + 512]
                code = np.array([[ord(c) for c in words[i]] for i in rows], np.uint64) + np.uint64(1)
                found = []
                for common, role in steps[n]:
                    kept = np.array(list(itertools.combinations(range(n), common)))
                    h = np.zeros((len(rows), len(kept)), np.uint64)
                    for j in range(common):
                        h += code[:, kept[:, j]] * rate[j]
                    h = (h + role) * rate[-2]
                    found.append(h ^ (h >> np.uint64(29)))
                h = np.concatenate(found, axis=1)
                ok = np.ones(h.shape, bool) if there is None else _in_bitmap(h, there)
                for i, x, y in zip(rows, h, ok, strict=True):
                    out[i] = np.unique(x[y]).view(np.int64)
        return pd.Series(out)

    return keys


def _in_bitmap(h: np.ndarray, there: np.ndarray) -> np.ndarray:
    bit = (h & np.uint64(BITS - 1)).astype(np.int64)
    return (there[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _bitmap(keys: DataFrame) -> np.ndarray:
    """The bits, BITS in all, that the low bits of the keys k name."""
    part = keys.select(F.shiftright(F.col("k").bitwiseAND(F.lit(BITS - 1)), 15).alias("part"), F.col("k").bitwiseAND(F.lit((1 << 15) - 1)).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in part.collect():  # BITS / 8 bytes
        out[r["part"] << 12 : (r["part"] + 1) << 12] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def near_tokens(tokens: DataFrame, least: float = 0.81) -> DataFrame:
    """(t, u): pairs of different tokens whose ratio 2 LCS / (n + m) is at least
    `least`, both ways. tokens: (t), and if wanted mine: of a pair one token is mine.

    Lossless: L = ceil(least (n + m) / 2) letters are common, so both words leave the same L
    letters when the shorter drops n - L and the longer m - L of its own. Words of up to LONGEST
    letters meet by the hash of these letters; the longer word has more ways to drop letters,
    and of these only such as a bitmap of the shorter words' ways may hold are spread. Pairs
    with a longer word see _near_long. The ratio is taken of what meets.
    """
    mine = F.max("mine") if "mine" in tokens.columns else F.lit(True)
    t = materialise(tokens.where(F.length("t") >= 3).groupBy("t").agg(mine.alias("mine")), "words")
    need = {(n, m): c for n in range(3, LONGEST + 1) for m in range(3, LONGEST + 1) if (c := math.ceil(least / 2 * (n + m) - 1e-9)) <= min(n, m)}
    rows = lambda keep, there=None: spread(t.where(F.length("t") <= LONGEST)).select("t", "mine", F.explode(_remnants({k: c for k, c in need.items() if keep(*k)}, there)("t")).alias("k"))
    shorter = materialise(rows(lambda n, m: n < m), "shorter_words")
    longer = rows(lambda n, m: n > m, _bitmap(shorter))
    equal = materialise(rows(lambda n, m: n == m), "equal_words")
    other = lambda x: x.select(F.col("t").alias("u"), F.col("mine").alias("_mine"), "k")
    pairs = shorter.join(other(longer), "k").unionByName(equal.join(other(equal), "k").where("t < u")).where("mine OR _mine").select("t", "u")
    pairs = pairs.unionByName(_near_long(t, least)).distinct()
    near = materialise(spread(pairs).where(ratio_udf("t", "u") >= least), "near_pairs")
    return near.unionByName(near.select(F.col("u").alias("t"), F.col("t").alias("u")))


def _near_long(words: DataFrame, least: float) -> DataFrame:
    """(t, u): candidates of near_tokens whose longer word u has more than LONGEST letters.

    The shorter word t loses n - L letters and gains m - L, and with them at most
    2 (n - L) + (m - L) of its bigrams. One of its rarest bigrams (by the long words that hold
    them), that many and one, is also u's; only those are joined, cut by the edit distance.
    """
    gram = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("t") - 1), lambda i: F.substring(F.col("t"), i, F.lit(2))))
    # the shorter word holds the common letters, at least `least` / 2 of both
    grams = words.where(F.length("t") >= math.ceil(least / (2 - least) * (LONGEST + 1) - 1e-9)).select("t", "mine", F.length("t").alias("n"), F.explode(gram).alias("g"))
    long = materialise(grams.where(F.col("n") > LONGEST), "long_grams")
    df = long.groupBy("g").agg(F.count("*").alias("df"))
    w = W.partitionBy("t").orderBy(F.coalesce("df", F.lit(0)), "g")
    a = grams.join(df, "g", "left").withColumn("p", F.row_number().over(w)).where("df > 0").drop("df")
    b = long.select(F.col("t").alias("u"), F.col("mine").alias("_mine"), F.col("n").alias("m"), "g")
    common = F.ceil(F.lit(least / 2) * (F.col("n") + F.col("m")) - 1e-9)
    lost = 2 * (F.col("n") - common) + (F.col("m") - common)
    shorter = (F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("t") < F.col("u")))
    # an edit is at most one letter lost and one gained, so edits can't be more than those
    edits = F.levenshtein("t", "u") <= F.col("n") + F.col("m") - 2 * common
    return a.join(b, "g").where("mine OR _mine").where(shorter & (common <= F.col("n")) & (F.col("p") <= lost + 1) & edits).select("t", "u").distinct()


def _name_tokens(names: DataFrame) -> DataFrame:
    """names with (form, t, last, number): the kernel's tokens of each name as it is (form 0) and with
    declared acronyms collapsed (form 1); last = of its last comma part, number = with
    digits, which the kernel doesn't ask a counterpart for."""
    @F.pandas_udf("array<struct<form:int,t:string,last:boolean,number:boolean>>")
    def split(name: pd.Series) -> pd.Series:
        def one(n):
            forms = dict.fromkeys([n.lower(), kernel.collapse_acronyms(n.lower())])
            out = []
            for form, f in enumerate(forms):
                tail, every = set(kernel.tokens([c for c in f.split(",") if c.strip()][-1])) if f.strip(" ,") else set(), kernel.tokens(f)
                telling = [x for x in every if x not in kernel.STOP] or every
                out += [{"form": form, "t": x, "last": x in tail, "number": any(c.isdigit() for c in x)} for x in dict.fromkeys(telling)]
            return out

        return name.map(one)

    return names.withColumn("x", F.explode(split("name"))).select(*names.columns, "x.*")


def fuzzy_pairs(left: DataFrame, right: DataFrame, least: float = 0.75, once: bool = False) -> DataFrame:
    """(kind, a, b, similarity): names of one kind whose kernel similarity is at least `least`;
    once leaves out those with a >= b.

    left and right: (kind, name), distinct. Two names can only be similar if every telling
    word of one without digits has a counterpart in the other. So each name asks with its rarest
    word without digits and the rarest such of its last comma part, for a near spelling; and with
    its rarer words after the rarest where the other holds an initial of that. Both sides ask,
    in either spelling (acronyms as declared or collapsed). Words with digits ask as well, in
    the same way: names of numbers or of initials and numbers have no other. Only names of
    different sides meet, where a side is all of left or of right. Scored once per distinct
    pair; a word that many names hold is spread by the holders.
    """
    sides = left.select("kind", "name", F.lit(True).alias("l"), F.lit(False).alias("r")).unionByName(right.select("kind", "name", F.lit(False).alias("l"), F.lit(True).alias("r")))
    sides = sides.groupBy("kind", "name").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    every = materialise(_name_tokens(sides), "name_tokens")
    near = near_tokens(every.select("t", F.col("l").alias("mine")))
    counts = every.groupBy("kind", "t").agg(F.countDistinct("name").alias("df"))
    # a word asks for its near ones too: a misspelled frequent word isn't rare
    holders = counts.unionByName(near.join(counts.withColumnRenamed("t", "u"), "u").select("kind", "t", "df")).groupBy("kind", "t").agg(F.sum("df").alias("df"))
    placed = materialise(every.join(holders, ["kind", "t"]).where(F.length("t") > 1), "asks")
    w = W.partitionBy("kind", "name", "form").orderBy("df", "t")
    asks = second = None
    for words in (placed, placed.where("NOT number")):
        ranked = words.withColumns({"p": F.row_number().over(w), "first": F.first("t").over(w)})
        tails = words.where("last").withColumn("p", F.row_number().over(w)).where(F.contains("name", F.lit(",")) & (F.col("p") == 1))
        one = ranked.where("p = 1").select("kind", "name", "l", "r", "t", F.lit(False).alias("part")).unionByName(tails.select("kind", "name", "l", "r", "t", F.lit(True).alias("part")))
        # the rarest word may stand as an initial on the other side: then one of the next must be there
        two = ranked.where("p >= 2").select("kind", "name", "l", "r", "t", F.substring("first", 1, 1).alias("letter"))
        asks, second = (one, two) if asks is None else (asks.unionByName(one).distinct(), second.unionByName(two).distinct())
    asks, second = materialise(asks, "first_asks"), materialise(second, "second_asks")
    initials = every.where(F.length("t") == 1).select("kind", F.col("name").alias("other"), F.col("t").alias("letter")).distinct()
    # last parts are compared with last parts; a word over a comma may belong to either
    part = F.contains("name", F.lit(",")) & (F.col("last") | F.contains("t", F.lit(",")))
    has = every.groupBy("kind", F.col("name").alias("other"), F.col("l").alias("other_l"), F.col("r").alias("other_r"), "t").agg(F.max(part).alias("other_part"))

    def wide(x: DataFrame) -> DataFrame:
        return x.unionByName(x.join(near, "t").select(*[F.col("u").alias("t") if c == "t" else F.col(c) for c in x.columns])).distinct()

    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted = lambda x: x.withColumn("salt", F.explode(salts))
    has = materialise(has, "held")
    held = has.withColumn("salt", F.pmod(F.xxhash64("other"), F.lit(SALTS)).cast("int"))
    across = (F.col("l") & F.col("other_r")) | (F.col("r") & F.col("other_l"))
    side = ["kind", "name", "other", "l", "r", "other_l", "other_r"]
    hits = salted(wide(asks)).join(held, ["kind", "t", "salt"]).where(across & (~F.col("part") | F.col("other_part"))).select(*side)
    # few names hold initials, so these are widened and not the frequent words that ask
    short = salted(second).join(wide(held.join(initials, ["kind", "other"])), ["kind", "t", "letter", "salt"]).where(across).select(*side)
    ways = [F.when(F.col("l") & F.col("other_r"), F.struct(F.col("name").alias("a"), F.col("other").alias("b"))), F.when(F.col("r") & F.col("other_l"), F.struct(F.col("other").alias("a"), F.col("name").alias("b")))]
    both = hits.unionByName(short).select("kind", F.explode(F.array_compact(F.array(*ways))).alias("x")).select("kind", "x.a", "x.b")
    both = materialise((both.where("a < b") if once else both).distinct(), "candidates")
    return spread(both).withColumn("similarity", similarity_udf("a", "b")).where(F.col("similarity") >= least)


def fuzzy_edges(nodes: DataFrame, least: float = 0.75) -> DataFrame:
    """(a, b, score), a < b: nodes of one type with similar names, score at 3 decimals.

    Names are compared once for each distinct pair. Of nodes with one name the smallest id
    stands for all: it has the edges to other names, and one of score 1 to each of the others,
    so that copies of a name aren't expanded into all pairs.
    """
    n = nodes.select("id", F.col("node_type").alias("kind"), "name").where("name IS NOT NULL")
    reps = materialise(n.groupBy("kind", "name").agg(F.min("id").alias("rep")), "representatives")
    names = reps.select("kind", "name")
    p = fuzzy_pairs(names, names, least, once=True)
    of = lambda c, i: reps.select("kind", F.col("name").alias(c), F.col("rep").alias(i))
    between = p.join(of("a", "i"), ["kind", "a"]).join(of("b", "j"), ["kind", "b"]).select("i", "j", F.col("similarity").alias("s"))
    same = n.join(reps, ["kind", "name"]).where("id <> rep").select(F.col("rep").alias("i"), F.col("id").alias("j"), F.lit(1.0).alias("s"))
    x = between.unionByName(same)
    return x.groupBy(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).agg(F.max(F.bround("s", 3)).alias("score"))


#: The tiers of matching in their order.
TIERS = ("exact", "alias", "equivalent", "acronym", "punctuation", "nickname", "fuzzy")


def match_names(asked: DataFrame, nodes: DataFrame, aliases: DataFrame, refs: DataFrame, upto: str = "fuzzy") -> DataFrame:
    """(kind, name, node_id, tier, score): what each asked (kind, name) resolves to, by the first
    tier that finds a live node of its type.

    exact name, then alias; equal equivalence key; a bare acronym that a node declares; equal
    letters and digits; a nickname (people); the most similar from 0.75 on, by a node's name
    that shares 0.3 of the words, or by an alias where the name shares fewer. Of several exact
    names and declared acronyms the most referenced wins, then the smaller id; elsewhere the
    node that came first (seq, where nodes have it), then the smaller id. Descriptions in
    brackets match nothing, and a person's name without a family name neither matches nor is
    matched (see match_in_record). Each tier is one join over distinct names; those behind
    `upto` aren't run.
    """
    scoped = (F.col("kind") == "person") & names.record_scoped("name")
    asked = asked.select("kind", "name").where(F.col("name").isNotNull() & ~text.is_description("name") & ~scoped).distinct()
    bare = (F.length(F.trim("name")) <= kernel.BARE) & ~F.contains(F.trim("name"), F.lit(" ")) & (F.upper("name") == F.col("name")) & (F.trim("name") != "")
    # exact names and aliases need no keys
    key = F.lit(None).cast("string") if TIERS.index(upto) < 2 else kernel.equivalence_udf("name")
    asked = materialise(asked.withColumns({"key": key, "blind": text.blind_key("name"), "bare": bare}), "asked")
    order = F.col("seq") if "seq" in nodes.columns else F.lit(0)
    n = nodes.select(F.col("node_type").alias("kind"), "name", F.col("id").alias("node_id"), order.cast("bigint").alias("seq")).where(F.col("name").isNotNull())
    n = n.where(~((F.col("kind") == "person") & names.record_scoped("name"))).distinct().join(refs, "node_id", "left").withColumn("refs", F.coalesce("refs", F.lit(0)))
    keys = n.select("name").distinct().withColumns({"key": key, "blind": text.blind_key("name"), "acr": text.trailing_acronym("name")})
    n = materialise(n.join(keys, "name").withColumnRenamed("name", "node_name"), "spelled")
    other = aliases.select("alias", "node_id").distinct().join(n.select("kind", "node_id", "node_name", "seq", "refs"), "node_id")
    found = []

    def tier(df: DataFrame, name: str, most_used: bool, score=None) -> None:
        by = -F.col("refs") if most_used else F.col("seq")
        found.append(df.select("kind", "name", "node_id", F.lit(TIERS.index(name)).alias("tier"), (F.lit(1.0) if score is None else score).alias("score"), by.cast("bigint").alias("by")))

    there = n.drop("node_name")
    tier(asked.join(n.withColumnRenamed("node_name", "name").drop("key", "blind", "acr"), ["kind", "name"]), "exact", True)
    tier(asked.join(other.withColumnRenamed("alias", "name").drop("node_name"), ["kind", "name"]), "alias", True)
    tier(asked.select("kind", "name", "key").join(there, ["kind", "key"]), "equivalent", False)
    tier(asked.where("bare").select("kind", "name", F.upper(F.trim("name")).alias("acr")).join(there.where("acr IS NOT NULL"), ["kind", "acr"]), "acronym", True)
    tier(asked.select("kind", "name", "blind").join(there.where("blind IS NOT NULL"), ["kind", "blind"]), "punctuation", False)
    rest = lambda c: F.regexp_replace(F.trim(F.regexp_replace(F.col(c), r"^\s*\S+\s*", "")), r"\s+", " ")
    people = asked.where("kind = 'person'").select("kind", "name", rest("name").alias("tail")).where("tail <> ''")
    # different names meet, nodes of one name come in afterwards
    spelled_people = n.where("kind = 'person'").select("kind", "node_name").distinct().withColumn("tail", rest("node_name"))
    nick = spread(people.join(spelled_people, ["kind", "tail"])).where(kernel.nickname_udf("name", "node_name")).select("kind", "name", "node_name")
    tier(nick.join(n.select("kind", "node_name", "node_id", "seq", "refs"), ["kind", "node_name"]), "nickname", False)
    found = found[: TIERS.index(upto) + 1]
    first = found[0]
    for x in found[1:]:
        first = first.unionByName(x)
    if upto == "fuzzy":
        first = materialise(first, "tiers")
        left = asked.join(first.select("kind", "name").distinct(), ["kind", "name"], "left_anti").select("kind", "name")
        spelled = n.select("kind", F.col("node_name").alias("name")).unionByName(other.select("kind", F.col("alias").alias("name"))).distinct()
        p = materialise(fuzzy_pairs(left, spelled), "fuzzy_pairs")
        wide = lambda c: F.array_distinct(F.split(F.lower(F.trim(c)), r"\s+"))
        share = lambda x, y: F.size(F.array_intersect(wide(x), wide(y))) / F.greatest(F.size(wide(x)), F.size(wide(y)))
        by_name = p.where(share("a", "b") >= kernel.OVERLAP).join(there.join(n.select("node_id", F.col("node_name").alias("b")), "node_id"), ["kind", "b"])
        by_alias = p.join(other.withColumnRenamed("alias", "b"), ["kind", "b"]).where(share("a", "node_name") < kernel.OVERLAP)
        for x in (by_name, by_alias):
            found.clear()
            tier(x.withColumnRenamed("a", "name"), "fuzzy", False, F.col("similarity"))
            first = first.unionByName(found[0])
    w = W.partitionBy("kind", "name").orderBy("tier", F.desc("score"), "by", "node_id")
    best = first.withColumn("p", F.row_number().over(w)).where("p = 1")
    return best.select("kind", "name", "node_id", F.element_at(F.array(*[F.lit(t) for t in TIERS]), F.col("tier") + 1).alias("tier"), F.round("score", 9).alias("score"))


def match_in_record(asked: DataFrame, people: DataFrame, aliases: DataFrame) -> DataFrame:
    """(record_id, name, node_id, via): the person that a record knows by a name, if any.

    asked: (record_id, name); people: (record_id, node_id, name), whom each record declares,
    quotes or refers to. By exact name, else by alias (of several the smallest id), else, for one
    word that is no initial, by the given or family name if exactly one of the record's people
    of two or more words carries it.
    """
    asked = asked.select("record_id", "name").where("name IS NOT NULL").distinct()
    people = materialise(people.select("record_id", "node_id", "name").distinct(), "people")
    by_name = asked.join(people, ["record_id", "name"]).groupBy("record_id", "name").agg(F.min("node_id").alias("by_name"))
    known = people.select("record_id", "node_id").distinct().join(aliases.select("node_id", F.col("alias").alias("name")).distinct(), "node_id")
    by_alias = asked.join(known, ["record_id", "name"]).groupBy("record_id", "name").agg(F.min("node_id").alias("by_alias"))
    w = names.person_words("name")
    carried = people.select("record_id", "node_id", w.alias("w")).where(F.size("w") > 1).select("record_id", "node_id", F.explode(F.array_distinct(F.array(F.col("w")[0], F.element_at("w", -1)))).alias("word"))
    carriers = carried.groupBy("record_id", "word").agg(F.countDistinct("node_id").alias("n"), F.min("node_id").alias("by_word")).where("n = 1").drop("n")
    one = F.when((F.size(w) == 1) & ~names.is_initial(w[0]), w[0])
    x = asked.withColumn("word", one).join(carriers, ["record_id", "word"], "left").join(by_name, ["record_id", "name"], "left").join(by_alias, ["record_id", "name"], "left")
    via = F.when(F.col("by_name").isNotNull(), "name").when(F.col("by_alias").isNotNull(), "alias").when(F.col("by_word").isNotNull(), "word")
    return x.select("record_id", "name", F.coalesce("by_name", "by_alias", "by_word").alias("node_id"), via.alias("via")).where("node_id IS NOT NULL")


def cross_type_twins(nodes: DataFrame) -> DataFrame:
    """(id_a, id_b, type_a, type_b, key): names in lower case that nodes of two types share,
    type_a < type_b. nodes: (id, node_type, name); nulls and blanks take no part."""
    k = nodes.select("id", "node_type", F.lower(F.trim(F.regexp_replace("name", r"\s+", " "))).alias("key")).where("key <> '' AND node_type IS NOT NULL AND id IS NOT NULL").distinct()
    several = k.groupBy("key").agg(F.countDistinct("node_type").alias("n")).where("n > 1").drop("n")
    k = k.join(several, "key", "left_semi")
    b = k.select(F.col("id").alias("id_b"), F.col("node_type").alias("type_b"), "key")
    return k.join(b, "key").where("node_type < type_b").select(F.col("id").alias("id_a"), "id_b", F.col("node_type").alias("type_a"), "type_b", "key")


def doubled_places(places: DataFrame) -> DataFrame:
    """(bare_id, compound_id): places without comma whose name is the last part of a compound
    one, with the first such (by seq). places: (id, name, seq)."""
    bare = places.where(~F.contains("name", F.lit(","))).select(F.col("id").alias("bare_id"), F.lower(F.trim("name")).alias("k"))
    long = places.where(F.contains("name", F.lit(","))).select("id", "seq", F.lower(F.trim(F.element_at(F.split("name", ","), -1))).alias("k"))
    return bare.join(long, "k").groupBy("bare_id").agg(F.min_by("id", F.struct("seq", "id")).alias("compound_id"))


def fuller_names(people: DataFrame) -> DataFrame:
    """(name, candidates, fuller): names whose given name is an initial, how many names spell it
    out, and the first of these. people: (name), distinct.

    Names meet by family name and first letter; only the deficient ones ask.
    """
    w = names.person_words("name")
    n = materialise(people.where(F.col("name").isNotNull() & ~names.record_scoped("name")).select("name", w.alias("w")).where(F.size("w") > 1).select("name", F.element_at("w", -1).alias("family"), F.substring(F.col("w")[0], 1, 1).alias("letter"), names.is_initial(F.col("w")[0]).alias("short")), "people")
    asks = n.where("short").select("family", "letter", "name")
    full = n.where("NOT short").select("family", "letter", F.col("name").alias("fuller"))
    x = spread(asks.join(full, ["family", "letter"])).where(kernel.fuller_udf("fuller", "name"))
    return x.groupBy("name").agg(F.count("*").alias("candidates"), F.min("fuller").alias("fuller"))


def resolve_unique(asked: DataFrame, nodes: DataFrame, aliases: DataFrame) -> DataFrame:
    """(name, state, node_id): unique where name or alias leads to exactly one live node,
    ambiguous to several, lost to none. Never guesses: node_id is null unless unique."""
    live = nodes.select(F.col("id").alias("node_id"), "name")
    routes = live.unionByName(aliases.select("node_id", F.col("alias").alias("name")).join(live.select("node_id"), "node_id", "left_semi")).distinct()
    hits = asked.select("name").where("name IS NOT NULL").distinct().join(routes, "name", "left").groupBy("name").agg(F.countDistinct("node_id").alias("n"), F.min("node_id").alias("m"))
    state = F.when(F.col("n") == 1, "unique").when(F.col("n") > 1, "ambiguous").otherwise("lost")
    return hits.select("name", state.alias("state"), F.when(F.col("n") == 1, F.col("m")).alias("node_id"))


def union_of_pairs(sources: dict[str, DataFrame], nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs (a, b, sources), dropped (source, n)): unordered pairs of several finders, one row
    each with who found it; pairs with a node that isn't live are dropped and counted."""
    every = None
    for name, df in sources.items():
        x = df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(name).alias("source")).where("a <> b").distinct()
        every = x if every is None else every.unionByName(x)
    live = nodes.select("id")
    kept = every.join(live.withColumnRenamed("id", "a"), "a", "left_semi").join(live.withColumnRenamed("id", "b"), "b", "left_semi")
    pairs = kept.groupBy("a", "b").agg(F.sort_array(F.collect_set("source")).alias("sources"))
    n = every.groupBy("source").agg(F.count("*").alias("found")).join(kept.groupBy("source").agg(F.count("*").alias("kept")), "source", "left")
    return pairs, n.select("source", (F.col("found") - F.coalesce("kept", F.lit(0))).alias("n"))
