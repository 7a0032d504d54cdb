"""Column expressions for the order of names: people by surname, places from the country down, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Regions by country.
REGIONS = {
    "USA": """Alabama, Alaska, Arizona, Arkansas, California, Colorado, Connecticut, Delaware, Florida, Georgia, Hawaii, Idaho, Illinois, Indiana, Iowa, Kansas, Kentucky, Louisiana, Maine, Maryland,
        Massachusetts, Michigan, Minnesota, Mississippi, Missouri, Montana, Nebraska, Nevada, New Hampshire, New Jersey, New Mexico, New York, North Carolina, North Dakota, Ohio, Oklahoma, Oregon,
        Pennsylvania, Rhode Island, South Carolina, South Dakota, Tennessee, Texas, Utah, Vermont, Virginia, Washington, West Virginia, Wisconsin, Wyoming, Washington DC, DC""",
    "Australia": "New South Wales, Victoria, Queensland, South Australia, Western Australia, Tasmania, Northern Territory, ACT, Australian Capital Territory",
    "Canada": """Alberta, British Columbia, Manitoba, New Brunswick, Newfoundland, Newfoundland and Labrador, Nova Scotia, Ontario, Prince Edward Island, Quebec, Saskatchewan, Yukon,
        Northwest Territories, Nunavut""",
    "United Kingdom": "England, Scotland, Wales, Northern Ireland",
    "New Zealand": """North Island, South Island, Auckland, Wellington, Canterbury, Otago, Waikato, Bay of Plenty, Manawatu, Hawkes Bay, Taranaki, Northland, Southland, Marlborough, Tasman, Nelson,
        West Coast, Gisborne""",
}
COUNTRY_OF = {r.strip(): country for country, text in REGIONS.items() for r in text.split(",")}
# Ranks that are taken off in front of a name, suffixes that stay with the surname.
RANKS = """Adm, Admiral, Air Marshal, Brig Gen, Brigadier General, Brigadier, Capt, Captain, Cdr, Col, Colonel, Commander, Commodore, Cpt, Dr, Fl Lt, Flight Lieutenant, Flt Lt, Gen, General, LCDR,
    Lt, Lt Cdr, Lt Col, Lt Gen, Lieutenant, Lieutenant Colonel, Lieutenant Commander, Lieutenant General, Maj, Maj Gen, Major, Major General, Mr, Mrs, Ms, Prof, Professor, Rear Admiral, Rev,
    Senator, Sen, Sgt, Sr, Vice Admiral"""
WITH_SURNAME = ("Jr", "Sr", "II", "III", "IV")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _longest_first(words) -> str:
    return "|".join(sorted((w.strip() for w in words), key=lambda w: (-len(w), w)))


#: A place that ends in a region: what stands before it, and the longest such region.
REGION_PATTERN = f"^(?:(.*?) )??({_longest_first(COUNTRY_OF)})$"
RANK_PATTERN = f"(?i)^(?:{_longest_first(RANKS.split(','))})\\.?\\s+"


def country_of(region: Column) -> Column:
    out = F.lit(None).cast("string")
    for country in REGIONS:
        out = F.when(region.isin(*[r for r, c in COUNTRY_OF.items() if c == country]), F.lit(country)).otherwise(out)
    return out


def place_order(c: str | Column) -> Column:
    """'Roswell New Mexico' as 'USA, New Mexico, Roswell' by the longest region that ends the name;
    a name with a comma or without a known region stays."""
    x = _col(c)
    region, rest = F.regexp_extract(x, REGION_PATTERN, 2), F.trim(F.regexp_extract(x, REGION_PATTERN, 1))
    turned = F.concat_ws(", ", country_of(region), region, F.when(rest != "", rest))
    return F.when(x.isNull() | F.contains(x, F.lit(",")) | (region == ""), x).otherwise(turned)


def without_rank(c: str | Column) -> Column:
    """Without one rank in front, the longest that fits."""
    return F.trim(F.regexp_replace(F.trim(_col(c)), RANK_PATTERN, ""))


def surname_order(c: str | Column) -> Column:
    """'Captain Ada M. Brenner Jr' as 'Brenner Jr, Ada M.'; a rank with one word leaves that word.
    A name with comma, brackets or digits, or of one word, stays."""
    x = _col(c)
    words = F.filter(F.split(without_rank(x), r"\s+"), lambda w: w != "")
    n = F.size(words)
    last = F.try_element_at(words, F.lit(-1))
    suffixed = F.coalesce(F.rtrim(last, F.lit(".")).isin(*WITH_SURNAME), F.lit(False)) & (n > 1)
    k = F.when(suffixed, n - 1).otherwise(n)
    surname = F.concat_ws(" ", F.try_element_at(words, k), F.when(suffixed, last))
    given = F.array_join(F.slice(words, F.lit(1), F.greatest(k - 1, F.lit(0))), " ")
    turned = F.when(n == 0, x).when(k == 1, surname).otherwise(F.concat_ws(", ", surname, given))
    return F.when(x.isNull() | x.rlike(r"[,()\p{Nd}]"), x).otherwise(turned)


def natural_person(c: str | Column) -> Column:
    """'Brenner, Ada M.' as 'Ada M. Brenner'; null for a name that isn't in that order."""
    x = _col(c)
    surname, given = F.trim(F.substring_index(x, ",", 1)), F.trim(F.regexp_extract(x, "(?s)^[^,]*,(.*)$", 1))
    return F.when((surname != "") & (given != ""), F.concat_ws(" ", given, surname))


def natural_place(c: str | Column) -> Column:
    """'USA, New Mexico, Roswell' as 'Roswell New Mexico', 'USA, Nevada' as 'Nevada'; null without a comma."""
    p = F.transform(F.split(_col(c), ","), lambda w: F.trim(w))
    return F.when(F.size(p) == 2, p[1]).when(F.size(p) > 2, F.concat_ws(" ", F.try_element_at(p, F.lit(3)), F.try_element_at(p, F.lit(2))))
