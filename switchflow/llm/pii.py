"""Personal data replaced by surrogates of the same kind, with DataFrame functions only.

E-mail and IP addresses, telephone, card and social security numbers, and names behind a
title are found by one pattern. A surrogate is drawn from a keyed hash of what the mention
names, so every spelling and every document gets the same one; it is poured into the
mention's own format. Names keep gender and script; a name that was found behind a title
is replaced wherever the same text repeats it. Where two entities draw one surrogate, or a
surrogate names another real entity, all but one draw again, from a wider range after some
draws; those for whom nothing is left change places among themselves.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchflow.llm.common import bind, whole_text
from switchflow.operators.topk import positions
from switchflow.session import materialize

ROUNDS = 12
WIDER = 4  # draws after which private addresses are taken from all of 10.0.0.0/8
HEX = "0123456789abcdef"

# Titles, and syllables that names are put together from.
TITLES_M = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин", "г-н", "Κύριος")
TITLES_F = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "Госпожа", "г-жа", "Κυρία")
TITLES_N = ("Dr", "Prof", "Professor", "Doctor", "Docteur", "Доктор", "Профессор", "Δρ")
SYLLABLES = {
    "latin": ("bar", "cor", "da", "del", "fen", "ga", "hol", "jo", "ka", "lin", "mar", "nor", "pe", "ros", "sel", "ta"),
    "cyrillic": ("бар", "вол", "га", "ден", "жу", "за", "кор", "лин", "ма", "нов", "пет", "ро", "сол", "та", "фед", "ча"),
    "greek": ("βα", "γαλ", "δη", "ζα", "θε", "κα", "λυ", "μαν", "νικ", "ξε", "πα", "ρο", "σα", "τελ", "φο", "χα"),
}
ENDINGS = {"latin": ("en", "ina"), "cyrillic": ("ан", "ина"), "greek": ("ης", "ια")}

_NAME = r"\p{Lu}[\p{L}'’]+(?:-\p{Lu}[\p{L}'’]+)?"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": r"(?<![0-9.])(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[0-9]{12}|(?: [0-9]{4}){3}|(?:-[0-9]{4}){3})(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(sorted(TITLES_M + TITLES_F + TITLES_N, key=len, reverse=True))})\.? +{_NAME}(?: +{_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
FEMALE, NEUTRAL = (rf"^(?:{'|'.join(t)})\b" for t in (TITLES_F, TITLES_N))
TYPES = tuple(PATTERNS)


def has_mentions(text: Column) -> Column:
    # Cheap tests first: most texts have neither digits in a row, nor @, nor the letters of a title.
    titles = sorted(TITLES_M + TITLES_F + TITLES_N, key=len)
    shortest = [t for i, t in enumerate(titles) if not any(s in t for s in titles[:i])]
    titled = reduce(or_, [text.contains(t) for t in shortest])
    return (text.contains("@") | text.rlike(r"[0-9][ .()-]{0,2}[0-9]") | titled) & text.rlike(ANY)


def mentions(text: Column) -> Column:
    """Array of (type, mention) from left to right; null where there is none."""
    kind = lambda m: (
        F.when(m.contains("@"), "email")
        .when(m.rlike(rf"^(?:{PATTERNS['ip']})$"), "ip")
        .when(m.rlike(rf"^(?:{PATTERNS['card']})$"), "card")
        .when(m.rlike(rf"^(?:{PATTERNS['ssn']})$"), "ssn")
        .when(m.rlike(r"^\p{L}"), "name")
        .otherwise("phone")
    )
    found = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda m: F.struct(kind(m).alias("type"), m.alias("mention")))
    return F.when(has_mentions(text), found)


def units(m: Column) -> Column:
    """What a mention names: (type, norm, surface) for each part that gets a surrogate."""
    kind, text = m["type"], m["mention"]
    words = F.split(F.regexp_replace(text, r"^\S+ +", ""), " +")
    gender = F.when(text.rlike(FEMALE), "f").when(text.rlike(NEUTRAL), "n").otherwise("m")

    def named(w: Column, i: Column) -> Column:
        script = F.when(w.rlike(r"\p{IsCyrillic}"), "cyrillic").when(w.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
        last = i == F.size(words) - 1
        return F.struct(F.concat(F.when(last, "last").otherwise(F.concat(F.lit("first_"), gender)), F.lit("_"), script).alias("type"), F.lower(w).alias("norm"), w.alias("surface"))

    digits = F.regexp_replace(text, "[^0-9]", "")
    norm = F.when(kind == "email", F.lower(text)).when(kind == "ip", F.regexp_replace(text, r"(^|\.)0+(?=[0-9])", "$1")).otherwise(digits)
    whole = F.array(F.struct(kind.alias("type"), norm.alias("norm"), text.alias("surface")))
    return F.when(kind == "name", F.transform(words, named)).otherwise(whole)


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def _digits(h: Column) -> Column:
    return F.translate(h, "abcdef", "038572")


def _letters(h: Column) -> Column:
    return F.translate(h, HEX, "aeiorntslkmdpbgv")


def _pour(text: Column, h: Column) -> Column:
    """The text with every digit and letter replaced by one of the hash's, position by position."""

    def char(c: Column, i: Column) -> Column:
        at = F.pmod(i, F.lit(64)) + 1
        return F.when(c.rlike("[0-9]"), F.substr(_digits(h), at, F.lit(1))).when(c.rlike("[a-z]"), F.substr(_letters(h), at, F.lit(1))).otherwise(c)

    return F.concat_ws("", F.transform(F.split(text, ""), char))


def _number(h: Column, at: int) -> Column:
    return F.conv(F.substring(h, at, 4), 16, 10).cast("int")


def _luhn(digits: Column) -> Column:
    """Sum of the check; a number is valid if 10 divides it."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)))
    return F.aggregate(values, F.lit(0), lambda s, x: s + x)


def _card(norm: Column, h: Column) -> Column:
    drawn = F.concat(F.substring(norm, 1, 1), F.substr(_digits(h), F.lit(1), F.length(norm) - 1))
    body = F.substr(drawn, F.lit(1), F.length(norm) - 1)
    check = F.pmod(10 - F.pmod(_luhn(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    valid = F.pmod(_luhn(norm), F.lit(10)) == 0
    return F.concat(body, F.when(valid, check.cast("string")).otherwise(F.substr(drawn, F.length(norm), F.lit(1))))


def _ip(norm: Column, h: Column, attempt: Column) -> Column:
    octet = F.split(norm, r"\.")
    private = norm.rlike(r"^(10|127|192\.168|172\.(1[6-9]|2[0-9]|3[01]))\.")
    two = norm.rlike(r"^(192|172)\.")
    drawn = [(F.pmod(_number(h, 1 + 4 * i), F.lit(254)) + 1).cast("string") for i in range(4)]
    public = F.element_at(F.array(*[F.lit(str(x)) for x in (23, 34, 45, 52, 63, 78, 81, 95, 104, 118, 139, 151, 167, 185, 203, 212)]), F.pmod(_number(h, 1), F.lit(16)) + 1)
    first = F.when(~private, public).when(attempt < WIDER, octet[0]).otherwise("10")
    return F.concat_ws(".", first, F.when(private & two & (attempt < WIDER), octet[1]).otherwise(drawn[1]), drawn[2], drawn[3])


def _phone(norm: Column, h: Column) -> Column:
    code = F.greatest(F.length(norm) - 10, F.lit(0))  # the country's code stays
    area = (F.pmod(_number(h, 61), F.lit(8)) + 2).cast("string")
    return F.concat(F.substr(norm, F.lit(1), code), area, F.substr(_digits(h), F.lit(1), F.length(norm) - code - 1))


def _email(norm: Column, h: Column, key: Column, attempt: Column) -> Column:
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    top = F.substring_index(domain, ".", -1)
    body = F.substr(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    # A redrawn address is longer, so that short ones do not run out.
    more = F.when(attempt > 0, F.substr(_letters(h), F.lit(40), F.least(attempt, F.lit(12)) + 1)).otherwise("")
    return F.concat(_pour(local, h), more, F.lit("@"), _pour(body, _hash(key, F.lit("domain"), domain)), F.lit("."), top)


def _name(kind: Column, h: Column, attempt: Column) -> Column:
    pick = lambda script, at: F.element_at(F.array(*[F.lit(s) for s in SYLLABLES[script]]), F.conv(F.substring(h, at, 1), 16, 10).cast("int") + 1)
    out = F.lit("")
    for script in SYLLABLES:
        parts = [pick(script, at) for at in (1, 2, 3)]
        longer = [F.when(attempt > k, pick(script, 4 + k)).otherwise("") for k in range(6)]
        male, female = ENDINGS[script]
        ending = F.when(kind.startswith("first_f"), female).when(kind.startswith("first_m"), male).otherwise("")
        out = F.when(kind.endswith(script), F.concat(*parts, *longer, ending)).otherwise(out)
    return out


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The surrogate's canonical form: digits alone for numbers, lower case for addresses and names."""
    k = F.lit(key)

    def of(h: Column) -> Column:
        return (
            F.when(kind == "email", _email(norm, h, k, attempt))
            .when(kind == "ip", _ip(norm, h, attempt))
            .when(kind == "card", _card(norm, h))
            .when(kind == "ssn", F.substr(_digits(h), F.lit(1), F.length(norm)))
            .when(kind == "phone", _phone(norm, h))
            .otherwise(_name(kind, h, attempt))
        )

    return bind(_hash(k, kind, norm, attempt.cast("string")), of)


def in_format(kind: Column, surface: Column, canonical: Column) -> Column:
    """The canonical surrogate in the spelling of the mention."""

    def char(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substr(surface, F.lit(1), i), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substr(canonical, before + 1, F.lit(1))).otherwise(c)

    poured = F.concat_ws("", F.transform(F.split(surface, ""), char))
    upper = (F.upper(surface) == surface) & (F.lower(surface) != surface)
    named = kind.startswith("first") | kind.startswith("last")
    return (
        F.when(kind == "ip", canonical)
        .when(kind == "email", F.when(upper, F.upper(canonical)).otherwise(canonical))
        .when(named, F.when(upper & (F.length(surface) > 1), F.upper(canonical)).otherwise(F.initcap(canonical)))
        .otherwise(poured)
    )


def _exchanged(rest: DataFrame, key: str) -> DataFrame:
    """(type, norm, canonical): each of the entities gets the next one's norm, in a keyed order among those of its type and length.

    An entity that is alone keeps its marks and gets zeros and x for digits and letters.
    """
    shaped = rest.select("type", F.length("norm").alias("size"), _hash(F.lit(key), F.lit("exchange"), "type", "norm").alias("h"), "norm")
    numbered = materialize(positions(shaped, ["type", "size", "h", "norm"], "at"), "pii-exchange")
    ends = numbered.groupBy("type", "size").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    asks = numbered.join(ends, ["type", "size"]).withColumn("next", F.when(F.col("at") < F.col("hi"), F.col("at") + 1).otherwise(F.col("lo")))
    given = numbered.select(F.col("at").alias("next"), F.col("norm").alias("other"))
    blank = F.regexp_replace(F.regexp_replace("norm", "[0-9]", "0"), r"\p{L}", "x")
    return asks.join(given, "next").select("type", "norm", F.when(F.col("hi") > F.col("lo"), F.col("other")).otherwise(blank).alias("canonical"))


def assign(entities: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """entities (type, norm), distinct -> (type, norm, canonical): a surrogate for each, all different and none a real entity.

    Entities that find no free surrogate in so many draws, as where most numbers of a
    length are real ones, exchange their own: all surrogates stay different, and none is
    the entity's own.
    """
    real = materialize(entities.select("type", F.col("norm").alias("canonical")), "pii-real")
    now = materialize(entities.withColumn("attempt", F.lit(0)), "pii-entities")
    for round_ in range(rounds):
        drawn = materialize(now.withColumn("canonical", surrogate(F.col("type"), F.col("norm"), F.col("attempt"), key)), "pii-drawn")
        # The entity that settled first keeps a surrogate; of equals, the first by norm.
        owner = drawn.groupBy("type", "canonical").agg(F.min(F.struct("attempt", "norm")).alias("owner"), F.count("*").alias("n")).filter("n > 1")
        taken = drawn.join(real, ["type", "canonical"], "left_semi").select("type", "norm")
        lost = drawn.join(owner, ["type", "canonical"]).filter("owner.norm <> norm").select("type", "norm")
        again = materialize(taken.union(lost).distinct(), "pii-again")
        if again.isEmpty():
            return drawn.select("type", "norm", "canonical")
        if round_ == rounds - 1:
            break
        now = drawn.drop("canonical").join(again.withColumn("redo", F.lit(1)), ["type", "norm"], "left")
        now = now.select("type", "norm", (F.col("attempt") + F.coalesce("redo", F.lit(0))).alias("attempt"))
    return drawn.join(again, ["type", "norm"], "left_anti").select("type", "norm", "canonical").union(_exchanged(again, key))


def renamed(text: Column, names: Column) -> Column:
    """The text with the names (surface, new) replaced where they stand as words of their own, all in one pass."""
    # Names are letters, apostrophes and hyphens. Longer ones first, so that a double name is not taken for its first half.
    longest = F.array_sort(names, lambda a, b: F.length(b["surface"]) - F.length(a["surface"]))
    pattern = F.concat(F.lit(r"(?<![\p{L}’'-])(?:"), F.array_join(F.transform(longest, lambda n: n["surface"]), "|"), F.lit(r")(?![\p{L}-])"))
    to = F.map_from_entries(names)
    found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda w: F.element_at(to, w))
    put = F.zip_with(F.split(text, pattern, -1), found, lambda part, new: F.array(part, F.coalesce(new, F.lit(""))))
    return F.concat_ws("", F.flatten(put))


def replace_pii(docs: DataFrame, key: str = "switchflow", text_column: str = "text", counts: bool = True) -> DataFrame:
    """docs with surrogates in the text and, with counts, a long column n_<type> per type.

    key should be the user's own secret; equal keys give equal surrogates. A null text
    stays null, other columns pass as they are (those named n_<type> are replaced when
    counts are asked for), repeated rows and null ids come back as often as they came,
    an empty table stays empty. The counts are of mentions found, not of later repeats of
    a name without its title, which are replaced too.
    """
    names = [f"n_{t}" for t in TYPES]
    kept = [c for c in docs.columns if not (counts and c in names)]
    text = whole_text(text_column)
    id_column = F.col("doc_id") if "doc_id" in docs.columns else F.lit(None).cast("long")
    # A row is known by its id and a hash of its text: rows equal in both have the same mentions.
    some = F.coalesce(has_mentions(text), F.lit(False))
    # Only rows with a mention are moved.
    keyed = docs.filter(some).select(*kept, id_column.alias("__id"), F.xxhash64(text).alias("__h"))
    found = docs.select(id_column.alias("__id"), F.xxhash64(text).alias("__h"), mentions(text).alias("found")).filter(F.size("found") > 0)
    found = found.select("__id", "__h", F.posexplode("found").alias("pos", "m"))
    found = found.select("__id", "__h", "pos", "m", F.posexplode(units(F.col("m"))).alias("part", "u")).distinct()
    found = materialize(found.select("__id", "__h", "pos", "part", F.col("m.type").alias("kind"), F.col("m.mention").alias("mention"), "u.type", "u.norm", "u.surface"), "pii-mentions")
    drawn = materialize(assign(found.select("type", "norm").distinct(), key), "pii-surrogates")
    new = found.join(drawn, ["type", "norm"]).select("__id", "__h", "pos", "part", "kind", "mention", "surface", in_format(F.col("type"), F.col("surface"), F.col("canonical")).alias("new"))
    title = F.regexp_extract("mention", r"^(\S+ +)", 1)
    both = F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("part", "new"))), lambda x: x["new"]))
    whole = new.groupBy("__id", "__h", "pos", "kind", "mention").agg(both.alias("new"))
    whole = whole.withColumn("new", F.when(F.col("kind") == "name", F.concat(title, "new")).otherwise(F.col("new")))
    # Names by their spelling in this text: where one stands for several entities, as a first and a last name, the first found.
    names_of = new.filter("kind = 'name'").groupBy("__id", "__h", "surface").agg(F.min_by("new", F.struct("pos", "part")).alias("new"))
    names_of = names_of.groupBy("__id", "__h").agg(F.collect_list(F.struct("surface", "new")).alias("__names"))
    per_row = whole.groupBy("__id", "__h").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "new"))), lambda x: x["new"]).alias("__new"),
        *[F.count_if(F.col("kind") == t).alias(f"__{n}") for t, n in zip(TYPES, names, strict=True)],
    )
    named = names_of.select(F.col("__id").alias("__id3"), F.col("__h").alias("__h3"), "__names")
    per_row = per_row.join(named, F.col("__id").eqNullSafe(F.col("__id3")) & (F.col("__h") == F.col("__h3")), "left").drop("__id3", "__h3")
    per_row = materialize(per_row, "pii-rows").withColumnsRenamed({"__id": "__id2", "__h": "__h2"})
    joined = keyed.join(per_row, F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__h") == F.col("__h2")), "left")
    between = F.split(F.col(text_column), ANY, -1)
    between = F.when(F.col("__names").isNotNull(), F.transform(between, lambda part: renamed(part, F.col("__names")))).otherwise(between)
    put = F.concat_ws("", F.flatten(F.zip_with(between, "__new", lambda p, n: F.array(p, F.coalesce(n, F.lit(""))))))
    new_text = F.when(F.col("__new").isNull(), F.col(text_column)).otherwise(put).alias(text_column)
    out = [new_text if c == text_column else F.col(c) for c in kept]
    changed = joined.select(*out, *([F.coalesce(f"__{n}", F.lit(0)).cast("long").alias(n) for n in names] if counts else []))
    same = docs.filter(~some).select(*kept, *([F.lit(0).cast("long").alias(n) for n in names] if counts else []))
    return same.unionByName(changed)
