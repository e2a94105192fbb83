"""PII surrogates with DataFrame operations alone.

Personal data is found by patterns and each entity gets one surrogate of its type, drawn by a keyed hash:
digits stay digits, letters stay letters of their case and script, cards and IBANs keep the validity of
their check digits. A name is two entities, given name and surname, so every mention of a person gets the
same replacement, with or without the given name and under any title; given names keep their gender. In a
document that names a person with a title, further mentions of the surname without one are replaced too.
Mentions of one entity in different notations get the same surrogate in their own notation. Surrogates
that meet, or that are themselves an entity of the corpus, are drawn again for all but one entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

# Titles, and what counts as an entity of each type, in order of precedence.
FEMALE_TITLES = "Mrs Ms Miss Frau Mme Madame Sra Señora Г-жа Госпожа".split()
MALE_TITLES = "Mr Herr Monsieur Sr Señor Г-н Господин".split()
OTHER_TITLES = "Dr Prof".split()
TITLE = "(?:" + "|".join(sorted([*FEMALE_TITLES, *MALE_TITLES, *OTHER_TITLES], key=lambda t: (-len(t), t))) + r")\.?\x20"
#: A capital and letters, or two letters or more of a script without capitals.
PART = r"(?:\p{Lu}\p{L}*+(?:['’-]\p{Lu}\p{L}*+)*+|\p{Lo}[\p{Lo}\p{M}]++)"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ip6": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|:(?::[0-9A-Fa-f]{1,4}){1,7}|(?=[0-9A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{1,4}:){1,7}:)(?![0-9A-Za-z:])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])(?:(?:[0-9]{4}[\x20-]?){3}[0-9]{4}|3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}|3[068][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{4}|4[0-9]{12}|6(?:[0-9]{3}[\x20-]?)(?:[0-9]{4}[\x20-]?){3}[0-9]{3})(?![A-Za-z0-9])",
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}(?:-[0-9]{2}-|\x20[0-9]{2}\x20)[0-9]{4}(?![A-Za-z0-9-])",
    "phone": r"(?<![A-Za-z0-9])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![A-Za-z0-9])|(?<![A-Za-z0-9+])\+(?=(?:[\x20.()/-]{0,2}[0-9]){7,15}(?![A-Za-z0-9]))[1-9](?:[\x20.()/-]{0,2}[0-9]){6,14}(?![A-Za-z0-9])",
    "name": rf"(?<!\p{{L}}){TITLE}{PART}(?:\x20(?!{TITLE}){PART})?",
}
SYLLABLES = {
    "latin": "ba da fa ga ka la ma na ra sa ta va be de fe ge ke le me ne re se te ve".split(),
    "cyrillic": "ба да га ка ла ма на ра са та ва бе де ге ке ле ме не ре се те ве".split(),
    "greek": "βα δα γα κα λα μα να ρα σα τα βε δε γε κε λε με νε ρε σε τε".split(),
}
#: Scripts without capitals: a class of their letters, the first of a run of these, and how many of the run are drawn from.
CASELESS = {
    "han": (r"\p{IsHan}", 0x4E00, 4096), "hangul": (r"\p{IsHangul}", 0xAC00, 4096), "kana": (r"[\p{IsHiragana}\p{IsKatakana}]", 0x30AB, 20), "arabic": (r"\p{IsArabic}", 0x0641, 8),
    "hebrew": (r"\p{IsHebrew}", 0x05D0, 26), "devanagari": (r"\p{IsDevanagari}", 0x0915, 36), "bengali": (r"\p{IsBengali}", 0x0995, 20), "tamil": (r"\p{IsTamil}", 0x0BAE, 10), "thai": (r"\p{IsThai}", 0x0E01, 46), "georgian": (r"\p{IsGeorgian}", 0x10D0, 33),
}
CASED = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}
#: How given names end, by script and gender.
ENDINGS = {("latin", "f"): "na", ("latin", "m"): "ro", ("latin", "n"): "li", ("cyrillic", "f"): "на", ("cyrillic", "m"): "рон", ("cyrillic", "n"): "ли", ("greek", "f"): "να", ("greek", "m"): "ρος", ("greek", "n"): "λι"}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
HINT = r"[0-9@]|::|(?<!\p{L})(?:Mr|Ms|Miss|Herr|Frau|Mme|Mons|Mad|Sr|Se|Dr|Prof)|Г-|Госп"
#: Draws that avoid every entity of the corpus, and draws that only avoid other surrogates and the entity itself.
DRAWS, MORE_DRAWS = 20, 20


def kind_of(raw: Column) -> Column:
    """The mention's type; mentions of known names without a title fit no pattern."""
    return F.coalesce(*(F.when(raw.rlike(rf"\A(?:{p})\z"), F.lit(k)) for k, p in PATTERNS.items()), F.lit("name"))


def canonical_of(kind: Column, raw: Column) -> Column:
    """What mentions of one entity have in common."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    return (
        F.when(kind == "phone", F.substring(F.regexp_replace(F.regexp_replace(raw, r"\A\+[0-9]{1,3}[^0-9]", ""), "[^0-9]", ""), -10, 10))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "iban", F.regexp_replace(raw, " ", ""))
        .when(kind.isin("email", "ip6"), F.lower(raw))
        .otherwise(raw)
    )


def name_parts(raw: Column) -> dict[str, Column]:
    """Title with its space, given name or null, surname, gender by the title, and script."""
    title = F.regexp_extract(raw, rf"\A{TITLE}", 0)
    parts = F.split(F.substr(raw, F.length(title) + 1), " ")
    bare = F.regexp_replace(title, r"[.\x20]", "")
    return {
        "title": title,
        "given": F.when(F.size(parts) > 1, F.get(parts, F.lit(0))),
        "surname": F.element_at(parts, -1),
        "gender": F.when(bare.isin(*FEMALE_TITLES), "f").when(bare.isin(*MALE_TITLES), "m"),
        # of the surname, which a mention always has
        "script": F.coalesce(*(F.when(F.element_at(parts, -1).rlike(p), F.lit(k)) for k, p in CASED.items()), *(F.when(F.element_at(parts, -1).rlike(p), F.lit(k)) for k, (p, _, _) in CASELESS.items()), F.lit("latin")),
    }


def _key(part: Column) -> Column:
    """Capitals and other notations of a name are one name."""
    return F.lower(part)


def _pick(seed: Column, at, n: int) -> Column:
    return F.pmod(F.xxhash64(seed, at), F.lit(n)).cast("int")


def _shaped(text: Column, seed: Column, digits: str = "0123456789", lower: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    """Each digit and each ASCII letter replaced by another drawn one of its class."""
    upper = lower.upper()

    def drawn(letters, i):
        return F.substr(F.lit(letters), _pick(seed, i, len(letters)) + 1, F.lit(1))

    def one(c, i):
        return F.when(c.between("0", "9"), drawn(digits, i)).when(c.between("a", "z"), drawn(lower, i)).when(c.between("A", "Z"), drawn(upper, i)).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """The check sum of a card number modulo 10."""
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    values = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.pmod(F.aggregate(values, F.lit(0), lambda a, x: a + x), F.lit(10))


def _card(canonical: Column, seed: Column) -> Column:
    """A number whose check sum is the original's, so that a valid one stays valid."""
    body = F.substr(_shaped(canonical, seed), F.lit(1), F.length(canonical) - 1)
    return F.concat(body, F.pmod(_luhn(canonical) - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))


def _rest97(text: Column) -> Column:
    """What the number that an IBAN stands for leaves modulo 97, its first four characters moved to the end."""
    chars = F.split(F.concat(F.substr(text, F.lit(5)), F.substring(text, 1, 4)), "")
    step = lambda a, c: F.when(c.between("0", "9"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(chars, F.lit(0), step)


def _iban(canonical: Column, seed: Column, second: Column) -> Column:
    """Country kept; the check digits fit if the original's do."""
    country, inner = F.substring(canonical, 1, 2), _shaped(F.substr(canonical, F.lit(5)), seed)
    fitting = F.lpad((98 - _rest97(F.concat(country, F.lit("00"), inner))).cast("string"), 2, "0")
    return F.concat(country, F.when(_rest97(canonical) == 1, fitting).otherwise(_shaped(F.substring(canonical, 3, 2), second)), inner)


def _name(kind: Column, detail: Column, seed: Column, attempt: Column) -> Column:
    """Syllables of the script; a given name ends as its gender does. Later draws are longer."""
    cases = []
    for (script, gender), ending in ENDINGS.items():
        some = F.array(*map(F.lit, SYLLABLES[script]))
        count = F.when(kind == "given", 2).otherwise(5) + F.floor(attempt / 4).cast("int")
        stem = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda k: F.get(some, _pick(seed, k, F.size(some)))), "")  # noqa: B023
        cases.append(F.when(detail == f"{script}-{gender}", F.initcap(F.concat(stem, F.when(kind == "given", ending).otherwise("")))))
    for script, (_, first, n) in CASELESS.items():
        count = F.when(kind == "given", 2).otherwise(3) + F.floor(attempt / 4).cast("int")
        drawn = F.transform(F.sequence(F.lit(1), count), lambda k: _letter(seed, k, first, n))  # noqa: B023
        cases.append(F.when(detail.startswith(f"{script}-"), F.array_join(drawn, "")))
    return F.coalesce(*cases)


def _letter(seed: Column, at, first: int, n: int) -> Column:
    """A drawn letter of the ``n`` from ``first`` on, from its UTF-16 code."""
    code = F.lit(first) + _pick(seed, at, n)
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 4, "0")), "UTF-16BE")


def with_surrogate(entities: DataFrame, attempt: int, key: str) -> DataFrame:
    """``entities`` (kind, detail, canonical) with the surrogate of a draw.

    The seeds are written down first, as an expression inside a lambda is worked out anew for each character.
    """
    kind, canonical, seed, second = map(F.col, ("kind", "canonical", "seed", "second"))
    seeded = cut(entities.withColumn("seed", F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", "detail", "canonical", F.lit(str(attempt))), 256)).withColumn("second", F.sha2("seed", 256)))
    local, domain = F.substring_index(canonical, "@", 1), F.substring_index(canonical, "@", -1)
    ending = F.substring_index(domain, ".", -1)
    host = F.substr(domain, F.lit(1), F.length(domain) - F.length(ending) - 1)
    added = _shaped(F.lit("x" * (8 + attempt // 4)), seed)  # where there is nothing to redraw, and where draws have run out
    drawn_local = F.concat(_shaped(local, seed), F.when(~local.rlike("[A-Za-z0-9]") | F.lit(attempt >= DRAWS), added).otherwise(""))
    surrogate = (
        F.when(kind == "email", F.concat(drawn_local, F.lit("@"), _shaped(host, second), F.lit("."), ending))
        .when(kind == "ip", F.concat_ws(".", *((_pick(seed, F.lit(k), 223 if k == 0 else 256) + (1 if k == 0 else 0)).cast("string") for k in range(4))))
        .when(kind == "ip6", F.concat(_shaped(canonical, seed, "0123456789", "abcdef"), F.when(canonical.rlike("(?:^|:)[0-9a-f]{1,3}$"), F.substring(second, 1, min(3, attempt // 4))).otherwise("")))
        .when(kind == "iban", _iban(canonical, seed, second))
        .when(kind == "card", _card(canonical, seed))
        .when(kind.isin("given", "surname"), _name(kind, F.col("detail"), seed, F.lit(attempt)))
        .otherwise(_shaped(canonical, seed))
    )
    return seeded.withColumn("surrogate", surrogate).drop("seed", "second")


def in_notation(kind: Column, raw: Column, surrogate: Column) -> Column:
    """The surrogate written as the mention is: its separators, and a phone's country code, stay."""
    digits = F.length(F.regexp_replace(raw, "[^0-9]", ""))
    offset = digits - F.length(surrogate)

    def fill(pattern):
        chars = F.split(raw, "")
        step = lambda acc, c: F.struct(
            F.concat(acc["out"], F.when(c.rlike(pattern) & (acc["n"] >= 0), F.substr(surrogate, acc["n"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (acc["n"] + F.when(c.rlike(pattern), 1).otherwise(0)).alias("n"),
        )
        start = F.struct(F.lit("").alias("out"), (-F.when(kind == "phone", offset).otherwise(0)).cast("int").alias("n"))
        return F.aggregate(chars, start, step)["out"]

    return F.when(kind.isin("card", "ssn", "phone"), fill("[0-9]")).when(kind == "iban", fill("[A-Z0-9]")).otherwise(surrogate)


def _written(part: Column, surrogate: Column) -> Column:
    return F.when((F.upper(part) == part) & (F.length(part) > 1), F.upper(surrogate)).otherwise(surrogate)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, detail, canonical, surrogate), distinct within each kind and no entity of the corpus.

    Where entities fill most of what a notation allows, so that ``DRAWS`` draws don't do, a surrogate may be
    another entity's value. Where a notation has no room for that either, the rest get letters of a hash, in
    whatever notation.
    """
    same = ["kind", "detail", "canonical"]
    pending = cut(entities.select(*same).distinct())
    known = F.when(F.col("kind").isin("given", "surname"), F.initcap("canonical")).otherwise(F.col("canonical"))
    taken = cut(pending.select("kind", known.alias("surrogate")).distinct())
    done = None
    for attempt in range(DRAWS + MORE_DRAWS):
        drawn = cut(with_surrogate(pending, attempt, key))
        used = None if done is None else done.select("kind", "surrogate")
        if attempt < DRAWS:
            used = taken if used is None else used.unionByName(taken)
        free = drawn.where(F.col("surrogate") != F.col("canonical")).join(used, ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(F.min(F.struct("detail", "canonical")).alias("e"))
        accepted = cut(first.select("kind", "e.detail", "e.canonical", "surrogate"))
        done = accepted if done is None else cut(done.unionByName(accepted))
        pending = cut(pending.join(accepted.select(*same), same, "left_anti"))
        if pending.isEmpty():
            return done
    hashed = F.translate(F.sha2(F.concat_ws("\x1f", F.lit(key), *same), 256), "0123456789", "ghijklmnop")
    return done.unionByName(pending.select(*same, hashed.alias("surrogate")))


def _pattern(names: Column) -> Column:
    """All patterns, and known names without a title unless ``names`` is null."""
    return F.coalesce(F.concat(F.lit(f"{ANY}|"), names), F.lit(ANY))


def _found(rows: DataFrame, names: Column) -> DataFrame:
    """(k1, k2, id, text, names, found): mentions in order; two hashes name a row, as equal rows have equal mentions."""
    keys = F.xxhash64("id", "text").alias("k1"), F.xxhash64(F.lit(1), "id", "text").alias("k2")
    return rows.select(*keys, "id", "text", names.alias("names")).withColumn("found", F.regexp_extract_all("text", _pattern(F.col("names")), F.lit(0)))


def pseudonymize(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text with surrogates, n_entities (mentions replaced).

    A null text stays null; texts without an entity, the empty one too, stay as they are; texts of any length
    are read whole. Repeated rows get equal results, ids may repeat or be null, and an empty table gives no
    rows. Further columns and their names don't matter. Where surrogates tie, the least entity keeps its draw.
    Surrogates depend on the key and the entity, and only where they collide on what else the corpus holds.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    personal = F.coalesce(F.when(F.col("text").rlike(HINT), F.col("text").rlike(ANY)), F.lit(False))
    hinted, others = rows.where(personal), rows.where(~personal)
    raw, kind = F.col("raw"), F.col("kind")

    def mentions_of(found: DataFrame) -> DataFrame:
        return found.select("k1", "k2", F.posexplode("found").alias("at", "raw")).distinct().withColumn("kind", kind_of(raw))

    # documents with titled names are searched again, for these names without a title
    titled = F.col("text").rlike(PATTERNS["name"])
    none = F.lit(None).cast("string")
    plain, named = _found(hinted.where(~titled), none), _found(hinted.where(titled), none)
    own = F.filter("found", lambda x: x.rlike(rf"\A(?:{PATTERNS['name']})\z"))
    bare = F.array_sort(F.array_distinct(F.flatten(F.transform(own, lambda x: F.array(F.regexp_replace(x, rf"\A{TITLE}", ""), F.substring_index(x, " ", -1))))), lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).otherwise(F.when(a < b, -1).when(a > b, 1).otherwise(0)))
    written = F.flatten(F.transform(bare, lambda x: F.array_distinct(F.array(x, F.upper(x)))))
    # scripts that put no spaces between words have no ends of words to look for
    named = _found(named.select("id", "text", "found"), F.array_join(F.transform(written, lambda x: F.when(x.rlike(r"[\p{IsHan}\p{IsThai}]"), x).otherwise(F.concat(F.lit(r"(?<!\p{L})"), x, F.lit(r"(?!\p{L})")))), "|"))

    found = cut(plain.unionByName(named).drop("text", "id"))
    mentions = cut(mentions_of(found).withColumn("canonical", canonical_of(kind, raw)))
    parts = name_parts(raw)
    name_forms = mentions.where("kind = 'name'").select("raw").distinct().select("raw", *(c.alias(n) for n, c in parts.items()))
    name_forms = cut(name_forms.withColumn("g", _key(F.col("given"))).withColumn("s", _key(F.col("surname"))))
    gender = F.when(F.count_if(F.col("gender") == "f") > F.count_if(F.col("gender") == "m"), "f").when(F.count_if(F.col("gender") == "m") > 0, "m").otherwise("n")
    givens = name_forms.where("g IS NOT NULL").groupBy("script", "g").agg(gender.alias("sex")).select(F.lit("given").alias("kind"), F.concat_ws("-", "script", "sex").alias("detail"), F.col("g").alias("canonical"))
    surnames = name_forms.select(F.lit("surname").alias("kind"), F.concat("script", F.lit("-n")).alias("detail"), F.col("s").alias("canonical"))
    others_of = mentions.where("kind <> 'name'").select("kind", F.lit("").alias("detail"), "canonical")
    given = assign(others_of.unionByName(givens).unionByName(surnames), key)

    plain_forms = mentions.where("kind <> 'name'").select("kind", "canonical", "raw").distinct().join(given.drop("detail"), ["kind", "canonical"]).select("kind", "raw", in_notation(kind, raw, F.col("surrogate")).alias("new"))
    first = given.where("kind = 'given'").select(F.substring_index("detail", "-", 1).alias("script"), F.col("canonical").alias("g"), F.col("surrogate").alias("new_g"))
    last = given.where("kind = 'surname'").select(F.substring_index("detail", "-", 1).alias("script"), F.col("canonical").alias("s"), F.col("surrogate").alias("new_s"))
    both = name_forms.join(last, ["script", "s"]).join(first, ["script", "g"], "left")
    new_name = F.concat("title", F.coalesce(F.concat(_written(F.col("given"), F.col("new_g")), F.lit(" ")), F.lit("")), _written(F.col("surname"), F.col("new_s")))
    forms = plain_forms.unionByName(both.select(F.lit("name").alias("kind"), "raw", new_name.alias("new")))

    placed = mentions.join(forms, ["kind", "raw"]).groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("at", "new"))).alias("new"))
    patterns = found.select("k1", "k2", "names").distinct().join(placed, ["k1", "k2"])
    whole = hinted.select("id", "text", F.xxhash64("id", "text").alias("k1"), F.xxhash64(F.lit(1), "id", "text").alias("k2")).join(patterns, ["k1", "k2"], "left")
    gaps = F.split(F.col("text"), _pattern(F.col("names")), -1)
    merged = F.array_join(F.flatten(F.zip_with(gaps, F.col("new")["new"], lambda g, n: F.array(g, F.coalesce(n, F.lit(""))))), "")
    changed = whole.select("id", F.when(F.col("new").isNull(), F.col("text")).otherwise(merged).alias("text"), F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("n_entities"))
    out = others.select("id", "text", F.lit(0).cast("long").alias("n_entities")).unionByName(changed)
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "n_entities")
