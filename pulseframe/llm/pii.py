"""Personal data replaced by surrogates, in DataFrame functions alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import saved, whole_text

KEY = "surrogate-1"
#: Rounds of collision checks after which surrogates get longer.
LENGTHEN_AFTER = 8

# Titles, and a part of a name.
_WOMEN = r"\b(?:Mrs|Ms|Mme|Sra|Frau|Miss|Señora|Madame|г-жа)\b"
_MEN = r"\b(?:Mr|Herr|Sr|Señor|Monsieur|г-н)\b"
_TITLES = f"{_WOMEN}|{_MEN}"
_PART = r"\p{Lu}(?:['’]\p{Lu})?\p{Ll}+(?:\p{Lu}\p{Ll}+)*(?![\p{L}])"
# Patterns of the entities, the most specific first.
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+\-]+@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}",
    "secret": r"(?<![\p{L}\p{N}])[0-9A-Fa-f]{32,}(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{N}]|\.\d)",
    "iban": r"(?<![\p{L}\p{N}])(?=[A-Z]{2}(?: ?[A-Z]{0,4} ?\d){10})[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}])(?<!\d{4}[ \-])\d{4}(?:[ \-]?\d{4}){3}(?![\p{L}\p{N}]|[ \-]\d{4}(?!\d))",
    "phone": r"(?<![\p{L}\p{N}])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){2,4}(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}\-])",
    "woman": rf"(?<={_WOMEN}\.? ){_PART}(?:[ \-](?!{_WOMEN}|{_MEN}){_PART})?",
    "man": rf"(?<={_MEN}\.? ){_PART}(?:[ \-](?!{_WOMEN}|{_MEN}){_PART})?",
}
# Syllables that surrogate names are made of, by script, and their endings.
SYLLABLES = {"latin": ("ba", "de", "fi", "go", "lu", "ma", "ne", "ri", "so", "tu", "va", "ze", "ka", "li", "mo", "pe"),
             "cyrillic": ("ба", "де", "фи", "го", "лу", "ма", "не", "ри", "со", "ту", "ва", "зе", "ка", "ли", "мо", "пе")}
ENDINGS = {"woman": ("na", "на"), "man": ("ron", "рон")}

_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_NAMES = ("woman", "man")


def _kind(value: Column) -> Column:
    """The entity's type: the first pattern that the whole value matches, names last by their title."""
    plain = [(k, p) for k, p in PATTERNS.items() if k not in _NAMES]
    return reduce(lambda rest, kp: F.when(value.rlike(f"^(?:{kp[1]})$"), F.lit(kp[0])).otherwise(rest), reversed(plain), F.lit("name"))


def _canonical(kind: Column, value: Column) -> Column:
    """What mentions of one entity have in common: digits of numbers, an account without spaces, otherwise lower case."""
    return F.when(kind.isin("card", "phone", "ssn"), F.regexp_replace(value, r"\D", "")) \
        .when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).otherwise(F.lower(value))


def _pattern(text: Column) -> Column:
    """The pattern of a text's entities: the fixed ones, and every mention of a name that has a title somewhere."""
    titled = F.regexp_extract_all(text, F.lit(f"{PATTERNS['woman']}|{PATTERNS['man']}"), F.lit(0))
    names = F.array_distinct(F.concat(titled, F.transform(titled, lambda n: F.substring_index(n, " ", -1))))
    # Longer names first, so that a surname does not take its full name's place.
    names = F.transform(F.sort_array(F.transform(names, lambda n: F.struct(F.length(n).alias("size"), n.alias("name"))), asc=False), lambda n: n["name"])
    bare = F.concat(F.lit(f"{_ANY}|(?<![\\p{{L}}\\p{{N}}])(?:"), F.array_join(names, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    return F.when(text.rlike(_TITLES) & (F.size(names) > 0), bare).otherwise(F.lit(_ANY))


def _last(some: Column) -> Column:
    return F.element_at(some, -1)


def entities(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, h, text) with ``entities``, the array of (kind, key, value, surname) of each text, in order.

    The gender of a name is that of the title before it. A surname stands for the only
    full name of its gender that ends in it; its key is the full name's then, and
    ``surname`` is true. A name without a title is the person last mentioned by it, or else the first.
    """
    found, between, people = F.col("found"), F.col("between"), F.col("people")

    def gender(kind: Column, i: Column) -> Column:
        before = F.concat(F.coalesce(F.get(found, i - 1), F.lit("")), F.get(between, i))
        return (F.when(kind != "name", F.lit(None).cast("string"))
                .when(before.rlike(rf"{_WOMEN}\.? $"), F.lit("woman")).when(before.rlike(rf"{_MEN}\.? $"), F.lit("man")))

    def full(p: Column, low: Column) -> Column:
        return p["key"].endswith(F.concat(F.lit(" "), low))

    def marked(m: Column, i: Column) -> Column:
        return F.struct(m["found"].alias("value"), m["kinds"].alias("kind"), F.lower(m["found"]).alias("low"), gender(m["kinds"], i).alias("own"))

    def titled(m: Column, i: Column) -> Column:
        return F.struct(m["own"].alias("kind"), m["low"].alias("key"), i.alias("i"))

    def addressed(m: Column, i: Column) -> Column:
        """With ``own`` the gender of the person that the name at place i stands for."""
        same = F.filter(people, lambda p: (p["key"] == m["low"]) | full(p, m["low"]))
        kind = F.coalesce(m["own"], _last(F.filter(same, lambda p: p["i"] < i))["kind"], F.get(same, F.lit(0))["kind"])
        return F.struct(m["value"].alias("value"), m["kind"].alias("kind"), m["low"].alias("low"), F.when(m["kind"] == "name", kind).alias("own"))

    def named(m: Column) -> Column:
        """With the full names that end in the name, and whether it is one itself."""
        ends = F.transform(F.filter(people, lambda p: (p["kind"] == m["own"]) & full(p, m["low"])), lambda p: p["key"])
        return F.struct(*(m[c].alias(c) for c in ("value", "kind", "low", "own")), F.array_distinct(ends).alias("ends"),
                        F.exists(people, lambda p: p["key"] == m["low"]).alias("whole"))

    def described(m: Column) -> Column:
        made = lambda kind, key, surname: F.struct(kind.alias("kind"), key.alias("key"), m["value"].alias("value"), surname.alias("surname"))
        n = F.size(m["ends"])
        return F.when(m["kind"] != "name", made(m["kind"], _canonical(m["kind"], m["value"]), F.lit(False))) \
            .when(n == 1, made(m["own"], F.get(m["ends"], F.lit(0)), F.lit(True))) \
            .otherwise(made(m["own"], F.when(m["whole"] | (n == 0), m["low"]).otherwise(_last(m["ends"])), ~m["whole"] & (n > 0)))

    # Columns of their own, so that a lambda does not search the text again for each entity. Arrays are built in
    # steps, as each use of a name would otherwise repeat the expression that found it, in the plan too.
    searched = rows.withColumn("pattern", _pattern(F.col("text"))).withColumns(
        {"found": F.regexp_extract_all("text", F.col("pattern"), F.lit(0)), "between": F.split("text", F.col("pattern"), -1)})
    marks = searched.withColumn("kinds", F.transform(found, _kind)).withColumn("marks", F.transform(F.arrays_zip("found", "kinds"), marked))
    known = marks.withColumn("people", F.filter(F.transform("marks", titled), lambda p: p["kind"].isNotNull()))
    who = known.withColumn("marks", F.transform("marks", addressed)).withColumn("marks", F.transform("marks", named))
    return who.select("doc_id", "h", F.transform("marks", described).alias("entities"))


def _digit(digest: Column, i: Column) -> Column:
    """The i-th number 0 to 15 of a hex digest, counted from 1, repeating."""
    return F.conv(F.substring(digest, F.pmod(i - 1, F.lit(64)).cast("int") + 1, F.lit(1)), 16, 10).cast("int")


def _like(value: Column, digest: Column) -> Column:
    """Every digit and letter replaced by one of its kind and script; other characters stay."""
    def one(char: Column, i: Column) -> Column:
        n = _digit(digest, i + 1)
        pick = lambda letters: F.substring(F.lit(letters), F.pmod(n * 5 + i, F.lit(len(letters))).cast("int") + 1, F.lit(1))
        return (F.when(char.rlike("^[0-9]$"), F.pmod(n + _digit(digest, i + 29), F.lit(10)).cast("string"))
                .when(char.rlike("^[a-z]$"), pick("abcdefghijklmnopqrstuvwxyz"))
                .when(char.rlike("^[A-Z]$"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
                .when(char.rlike(r"^\p{IsCyrillic}$"), pick("абвгдежзиклмнопрстуфхцчшэюя"))
                .when(char.rlike(r"^\p{L}$"), pick("áâãäåæçèéêëìíîïñòóôõöùúûüý"))
                .otherwise(char))
    return F.concat_ws("", F.transform(F.filter(F.split(value, ""), lambda c: c != ""), one))


def _name(kind: Column, key: Column, digest: Column, length: Column) -> Column:
    """A name for each part of the name, of its script, with the ending of its gender."""
    cyrillic = key.rlike(r"\p{IsCyrillic}")
    syllables = lambda script: F.array(*map(F.lit, SYLLABLES[script]))

    def part(_: Column, p: Column) -> Column:
        # Surnames are told apart across all people, so they have one more syllable to choose.
        picked = F.concat_ws("", F.transform(F.sequence(F.lit(1), length + F.when(p > 0, 1).otherwise(0)), lambda i: F.element_at(
            F.when(cyrillic, syllables("cyrillic")).otherwise(syllables("latin")), _digit(digest, i + p * 11) + 1)))
        ending = F.when(p > 0, F.lit("")).when(kind == "woman", F.when(cyrillic, ENDINGS["woman"][1]).otherwise(ENDINGS["woman"][0])) \
            .otherwise(F.when(cyrillic, ENDINGS["man"][1]).otherwise(ENDINGS["man"][0]))
        return F.concat(picked, ending)

    return F.concat_ws(" ", F.transform(F.split(key, "[ \\-]"), part))


def _digest(key: str) -> Column:
    """What the surrogate of the columns kind, key and attempt is drawn with."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", "key", F.col("attempt").cast("string")), 256)


def _surrogate() -> Column:
    """The surrogate, in canonical form, of the columns kind, key, attempt and digest."""
    digest = F.col("digest")
    # Past LENGTHEN_AFTER rounds a format may be full: longer surrogates always find room.
    more = F.greatest(F.col("attempt") - LENGTHEN_AFTER, F.lit(0))
    tail = F.when(more > 0, F.regexp_replace(F.substring(digest, F.lit(1), F.least(more, F.lit(60)).cast("int")), "[a-f]", "7")).otherwise("")
    octets = F.concat_ws(".", *(
        (F.lit(1) + F.pmod(F.conv(F.substring(digest, 4 * i + 1, 4), 16, 10).cast("long"), F.lit(223 if i == 0 else 254))).cast("string")
        for i in range(4)))
    host = F.concat(F.lit("mail"), F.pmod(_digit(digest, F.lit(60)), F.lit(10)).cast("string"), F.lit(".example.org"))
    local = F.regexp_extract("key", "^([^@]*)@", 1)
    phone = F.concat(F.substring("key", 1, 1), F.expr("substring(key, 2)"))
    return (
        F.when(F.col("kind") == "email", F.concat(_like(local, digest), tail, F.lit("@"), host))
        .when(F.col("kind") == "ip", F.concat(octets, F.when(more > 0, F.concat(F.lit("."), tail)).otherwise("")))
        .when(F.col("kind") == "secret", F.substring(F.repeat(F.concat(digest, F.sha2(digest, 256)), 8), F.lit(1), F.length("key") + more))
        .when(F.col("kind") == "iban", F.concat(F.substring("key", 1, 2), _like(F.expr("substring(key, 3)"), digest), tail))
        .when(F.col("kind").isin("card", "ssn"), F.concat(_like(F.col("key"), digest), tail))
        .when(F.col("kind") == "phone", F.concat(F.substring(phone, 1, 1), _like(F.expr("substring(key, 2)"), digest), tail))
        .otherwise(_name(F.col("kind"), F.col("key"), digest, F.lit(3) + more))
    )


def _claims(kind: Column, value: Column) -> Column:
    """The texts that may stand for an entity: all of it, and of a name of several parts its last part too."""
    return F.array_distinct(F.array(value, F.when(kind.isin(*_NAMES), F.element_at(F.split(value, "[ \\-]"), -1)).otherwise(value)))


def surrogate_table(mentions: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, key, surrogate) of each distinct entity of ``mentions`` (kind, key).

    A surrogate depends on ``key``, kind and entity, so mentions agree wherever they
    stand. Surrogates that meet another one, or a real entity, are checked out by joins
    and drawn again until all are distinct; a surname, by which a text may call a person,
    meets no other surname or name either.
    """
    real = saved(mentions.select("kind", "key").distinct(), "entities")
    known = real.select(F.explode(_claims(F.col("kind"), F.col("key"))).alias("claim"))
    settled, open_ = None, real.withColumn("attempt", F.lit(0))
    while True:
        drawn = open_.withColumn("digest", _digest(key)).withColumn("surrogate", _surrogate())
        claimed = drawn.withColumn("claim", F.explode(_claims(F.col("kind"), F.col("surrogate"))))
        # Of entities with one surrogate the first has it, unless it is taken or real.
        owner = claimed.groupBy("claim").agg(F.min(F.struct("kind", "key")).alias("owner"))
        taken = known
        if settled is not None:
            taken = taken.union(settled.select(F.explode(_claims(F.col("kind"), F.col("surrogate")))))
        owner = owner.join(taken, "claim", "left_anti").withColumn("mine", F.lit(True))
        mine = F.coalesce(F.col("mine") & (F.col("owner") == F.struct("kind", "key")), F.lit(False))
        checked = saved(
            claimed.join(owner, "claim", "left").withColumn("mine", mine)
            .groupBy("kind", "key", "attempt", "surrogate").agg(F.min("mine").alias("mine")), "surrogates")
        won = checked.filter("mine").select("kind", "key", "surrogate")
        settled = won if settled is None else settled.union(won)
        lost = checked.filter("NOT mine")
        if lost.isEmpty():
            return settled
        open_ = lost.select("kind", "key", (F.col("attempt") + 1).alias("attempt"))


def _dressed(kind: Column, value: Column, surrogate: Column, surname: Column) -> Column:
    """The surrogate in the format of this mention: its separators, or its case; of a surname, the last part."""
    def formatted(kept: str, own: str) -> Column:
        """The surrogate's characters in place of the mention's own ones, and what is longer after them."""
        count = lambda text: F.length(F.regexp_replace(text, own, ""))
        before = F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: count(F.substring(value, F.lit(1), i)))
        chars = F.transform(F.filter(F.split(value, ""), lambda c: c != ""), lambda c, i: F.when(
            c.rlike(kept), F.substring(surrogate, F.element_at(before, i + 1), F.lit(1))).otherwise(c))
        return F.concat(F.concat_ws("", chars), F.substring(surrogate, count(value) + 1, F.length(surrogate)))

    return (
        F.when(kind.isin("card", "phone", "ssn"), formatted(r"^\d$", r"\D"))
        .when(kind == "iban", formatted("^[^ ]$", " "))
        .when(kind.isin(*_NAMES), F.initcap(F.when(surname, F.substring_index(surrogate, " ", -1)).otherwise(surrogate)))
        .when((value == F.upper(value)) & (value != F.lower(value)), F.upper(surrogate))
        .otherwise(surrogate)
    )


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """One row per document: doc_id, text with surrogates, n_entities.

    Emails, long hex secrets, IPv4 addresses, account (IBAN), card, phone and social
    security numbers and names behind a title are replaced, as is every other mention of such a full name or
    surname in the same text; equal entities get equal surrogates across the
    whole table, different ones different surrogates of the same type, script, gender and
    format; people are told apart by their surnames alone too. An account keeps its country
    and its grouping. Texts without entities, empty and null ones stay as they are, an empty
    table gives an empty result, and texts of any length are searched whole. Rows that repeat
    are treated each; a null doc_id stays null; other columns do not matter.
    """
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"))
    has = F.coalesce(F.col("text"), F.lit("")).rlike("[@0-9]|\\b(?:Mr|Mrs|Ms|Mme|Miss|Herr|Frau|Sra?|Señora?|Madame|Monsieur|г-н|г-жа)\\b")
    # An inner generator makes Spark ask first, below, whether there are entities, and so search the text twice.
    found = entities(rows.filter(has)).select("doc_id", "h", F.posexplode_outer("entities").alias("place", "e"))
    found = saved(found.filter("place IS NOT NULL").select("doc_id", "h", "place", "e.*"), "mentions")
    table = surrogate_table(found, key)
    dressed = found.join(table, ["kind", "key"]).select(
        F.col("doc_id").alias("d"), F.col("h").alias("g"), "place",
        _dressed(F.col("kind"), F.col("value"), F.col("surrogate"), F.col("surname")).alias("surrogate"))
    # Rows that repeat a text under one doc_id tell the same entities.
    by_doc = dressed.groupBy("d", "g").agg(F.sort_array(F.collect_set(F.struct("place", "surrogate"))).alias("new"))
    between = F.split(F.col("text"), _pattern(F.col("text")), -1)
    rebuilt = F.concat_ws("", F.transform(between, lambda part, i: F.concat(
        part, F.coalesce(F.get(F.col("new"), i)["surrogate"], F.lit("")))))
    return rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left").select(
        "doc_id", F.when(F.col("new").isNull(), F.col("text")).otherwise(rebuilt).alias("text"),
        F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("n_entities"))
