"""Personal data replaced by keyed surrogates, with DataFrame functions only.

Found values are put in a canonical form (digits of a number, lower case of an
address), so that one person or number gets one surrogate wherever and however
it is written. A surrogate is made from a keyed hash: it has the type, length,
separators, letter case, script and grammatical gender of what it replaces.
Surrogates, given names too, are checked against each other and against all values of the corpus;
whoever collides draws again, so different values stay different.

Texts of any length and shape are read in linear time: every repeat inside a pattern
is bounded or can't be entered twice.

Not found: names without a listed title, numbers of national forms other than
3-3-4, and account numbers without a country. Check digits are not tested, neither
of what is found nor of what replaces it.

Values are shuffled, not texts: only documents that hold a value are joined with
their replacements, and a value that sits in a third of all documents is one row
per task when values are collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelrisk.llm.scratch import Scratch

# fixed values: titles that show the gender of a name
TITLES = {
    "m": ["Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа"],
    "n": ["Dr", "Prof"],
}
# fixed values: given names by gender and script
GIVEN = {
    ("m", "latin"): ["Adam", "Brian", "Carl", "David", "Eric", "Frank", "George", "Henry"],
    ("f", "latin"): ["Alice", "Bella", "Clara", "Diana", "Emma", "Fiona", "Grace", "Helen"],
    ("n", "latin"): ["Alex", "Robin", "Kim", "Sascha", "Noel", "Jamie", "Morgan", "Taylor"],
    ("m", "cyrillic"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"],
    ("f", "cyrillic"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Зоя", "Ирина", "Ольга"],
    ("n", "cyrillic"): ["Саша", "Женя", "Валя", "Шура", "Слава", "Тоня", "Вася", "Паша"],
}
GIVEN |= {
    ("m", "greek"): ["Γιώργος", "Δημήτρης", "Κώστας", "Μιχάλης", "Νίκος", "Πέτρος", "Σπύρος", "Τάσος"],
    ("f", "greek"): ["Άννα", "Ελένη", "Ιωάννα", "Κατερίνα", "Μαρία", "Σοφία", "Φωτεινή", "Χριστίνα"],
    ("n", "greek"): ["Αλέξις", "Φάνης", "Χάρις", "Άρτεμις", "Μύρων", "Ρήγας", "Κίμων", "Λέων"],
}
SYLLABLES = {
    "latin": ["ba", "be", "do", "fa", "ga", "ho", "ka", "le", "ma", "ne", "po", "ra", "so", "ta", "vi", "zu"],
    "cyrillic": ["ба", "бе", "до", "фа", "га", "хо", "ка", "ле", "ма", "не", "по", "ра", "со", "та", "ви", "зу"],
    "greek": ["βα", "βε", "δο", "φα", "γα", "χο", "κα", "λε", "μα", "νε", "πο", "ρα", "σο", "τα", "βι", "ζου"],
}

# a word of a name, with what an apostrophe or hyphen joins to it
NAME = r"\p{Lu}(?:\p{L}++(?:['’-]\p{L}++){0,4}+|['’]\p{L}++(?:['’-]\p{L}++){0,4}+)"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}+\.){1,127}[A-Za-z]{2,63}",
    "ip": rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?![\w]|\.\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
             r"|(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,4}){2,4}(?!\d)"
             r"|(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,4}){1,3}[ .-]\d{5,8}(?!\d)|(?<![\w+])\+[1-9]\d{7,14}(?!\d)"
             r"|(?<![\w.+-])[2-9]\d{2}-\d{3}-\d{4}(?![\w-])|(?<![\w.+-])[2-9]\d{2}\.\d{3}\.\d{4}(?!\w|\.\d)",
    "card": r"(?<![\w.-])\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}(?![\w-])|(?<![\w.])\d{13,19}(?![\w])"
            r"|(?<![\w.-])3[47]\d{2}[ -]\d{6}[ -]\d{5}(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?!\w)"
            r"|(?<!\w)(?=[A-Z0-9 ]{0,34}(?:\d[A-Z ]{0,9}){10})[A-Z]{2}\d{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?(?!\w)",
    "token": r"(?<!\w)(?=[0-9a-fA-F]*[0-9])[0-9a-fA-F]{32,}(?!\w)",
    "name": r"(?<!\w)(?:" + "|".join(t for ts in TITLES.values() for t in ts)
            + rf")\.? {NAME}(?: {NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# cheap test that every match passes: an @, five characters of a number, or a title
HINT = r"@|\d[\d.() -]{4}|[0-9a-fA-F]{32}|[A-Z]{2}\d\d|(?:" + "|".join(
    t for ts in TITLES.values() for t in ts) + r")\.? \p{Lu}"
PLAIN = 3  # draws of a single given name, later ones join more and more of them
DRAWS = 16  # draws after which a surrogate may be longer than what it replaces


def _matches(text: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)


def _type_of(value: Column) -> Column:
    out = F.lit("name")
    for kind in reversed([k for k in PATTERNS if k != "name"]):
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _parts(kind: Column, value: Column) -> Column:
    """What is replaced one by one: the whole value, or title, given name and surname."""
    words = F.split(value, " ")
    gender = F.lit("n")
    for g in ("m", "f"):
        gender = F.when(F.regexp_replace(words[0], r"\.$", "").isin(TITLES[g]), g).otherwise(gender)

    def part(word: Column, i: Column) -> Column:
        role = F.when(i == 0, "title").when(i == F.size(words) - 1, "surname").otherwise(F.concat(F.lit("given-"), gender))
        return F.struct(role.alias("kind"), word.alias("surface"))

    whole = F.array(F.struct(kind.alias("kind"), value.alias("surface")))
    return F.when(kind == "name", F.transform(words, part)).otherwise(whole)


def _canonical(kind: Column, surface: Column) -> Column:
    digits = F.regexp_replace(surface, r"\D", "")
    plain = F.lower(F.when(kind == "iban", F.regexp_replace(surface, " ", "")).otherwise(surface))
    return F.when(kind.isin("phone", "card", "ssn"), digits).otherwise(plain)


def find_values(docs: DataFrame) -> DataFrame:
    """(uid, at, part, kind, surface, canon) of every value in every text, in order."""
    found = docs.select("uid", F.posexplode(_matches(F.col("text"))).alias("at", "value"))
    typed = found.withColumn("kind", _type_of(F.col("value")))
    parts = typed.select("uid", "at", F.posexplode(_parts(F.col("kind"), F.col("value"))).alias("part", "p"))
    return parts.select(
        "uid", "at", "part", F.col("p.kind").alias("kind"), F.col("p.surface").alias("surface"),
        _canonical(F.col("p.kind"), F.col("p.surface")).alias("canon"),
    )


def _drawn(key: str) -> Column:
    """Surrogate of (kind, canon) for the number of the draw.

    Later draws come from a larger space: addresses and surnames grow with every
    draw, given names from draw ``PLAIN`` on, numbers get further digits from draw
    ``DRAWS`` on, so every value finds one.
    """
    seed = F.concat_ws("\x1f", F.lit(key), "kind", "canon", F.col("draw").cast("string"))
    stream = F.concat(*[F.sha2(F.concat(seed, F.lit(f"\x1f{i}")), 256) for i in range(2)])
    # bound as an element, so that the hash of a long value is not taken for each of its characters
    kinds = F.transform(F.array(stream), lambda s: F.struct(
        s.alias("stream"), F.translate(s, "abcdef", "840295").alias("digits"),
        F.translate(s, "0123456789", "ghijklmnop").alias("letters"),
        F.translate(s, "0123456789", "abcdefabcd").alias("hexes")))
    return F.transform(kinds, lambda s: _made(s["stream"], s["digits"], s["letters"], s["hexes"]))[0]


def _made(stream: Column, digits: Column, letters: Column, hexes: Column) -> Column:
    """Surrogate of (kind, canon, draw) from 128 hashed digits, letters and hexadecimal letters."""
    def shaped(text: Column, letter: Column, fixed: int = 0) -> Column:
        def one(c: Column, i: Column) -> Column:
            at = F.pmod(i, F.lit(128)) + 1
            return (
                F.when(i < fixed, c).when(c.rlike("[0-9]"), F.substr(digits, at, F.lit(1)))
                .when(c.rlike("[a-z]"), F.substr(letter, at, F.lit(1))).otherwise(c)
            )
        return F.array_join(F.transform(F.split(text, ""), one), "")

    def number(at: int, width: int) -> Column:
        return F.conv(F.substr(stream, F.lit(at), F.lit(width)), 16, 10).cast("long")

    canon = F.col("canon")
    ip = F.concat_ws(".", (number(1, 6) % 223 + 1).cast("string"), *[
        (number(7 + 6 * i, 6) % 256).cast("string") for i in range(3)])
    email = F.concat(shaped(F.substring_index(canon, "@", 1), letters), F.lit("@mail"),
                     F.substr(digits, F.lit(65), F.col("draw") + 3), F.lit(".example.org"))
    more = F.substr(F.reverse(digits), F.lit(1), F.greatest(F.col("draw") - DRAWS + 1, F.lit(0)))
    out = F.when(F.col("kind") == "email", email).when(F.col("kind") == "ip", F.concat(ip, more))
    out = out.when(F.col("kind") == "token", F.concat(shaped(canon, hexes), more))
    out = out.when(F.col("kind") == "iban", F.concat(shaped(canon, letters, 2), more))
    for script, syllables in SYLLABLES.items():
        own = _script(canon) == script
        pick = lambda i: F.array(*map(F.lit, syllables))[(number(1 + 4 * i, 4) % len(syllables)).cast("int")]
        out = out.when((F.col("kind") == "surname") & own, F.concat(
            *[pick(i) for i in range(5)],
            F.array_join(F.transform(F.sequence(F.lit(0), F.col("draw")), lambda i: F.when(i > 0, F.array(*map(F.lit, syllables))[
                (F.conv(F.substr(stream, 24 + 2 * i, F.lit(2)), 16, 10).cast("int") % len(syllables))]).otherwise("")), "")))
        for (gender, of), names in GIVEN.items():
            if of == script:
                one = lambda i: F.array(*map(F.lit, names))[
                    (F.conv(F.substr(stream, 41 + 4 * (i % 22), F.lit(4)), 16, 10).cast("long") % len(names)).cast("int")]
                joined = F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(F.col("draw") - PLAIN, F.lit(0))), one), "-")
                out = out.when((F.col("kind") == f"given-{gender}") & own, F.lower(joined))
    return out.otherwise(F.concat(shaped(canon, letters, 1), more))  # phone, card, ssn keep their first digit


def _family(kind: Column) -> Column:
    """Kinds whose values could be taken for each other: names, digits, and each other kind alone."""
    return F.when(kind.rlike("^(surname|given)"), "names").when(kind.isin("phone", "card", "ssn"), "digits").otherwise(kind)


def surrogates(values: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, canon, surrogate) of the distinct values, without collisions.

    No two values of a family share a surrogate, and no surrogate is a value of the corpus.
    """
    distinct = scratch.write(values.where("kind <> 'title'").select("kind", "canon").distinct(), "distinct")
    family, made = _family(F.col("kind")).alias("family"), _drawn(key).alias("surrogate")
    real = distinct.select(family, F.col("canon").alias("surrogate"))
    settled, open_values, draw = None, distinct, 0
    first = F.min(F.struct(F.xxhash64("kind", "canon").alias("at"), "kind", "canon")).alias("first")
    while True:
        # only values without a surrogate draw; a surrogate has one drawer but for those that collide
        drawn = scratch.write(
            open_values.withColumn("draw", F.lit(draw)).select(family, "kind", "canon", made), f"drawn-{draw}")
        free = drawn.groupBy("family", "surrogate").agg(first).join(real, ["family", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled, ["family", "surrogate"], "left_anti")
        free = scratch.write(free.select("family", "first.kind", "first.canon", "surrogate"), f"free-{draw}")
        settled = free if settled is None else settled.unionByName(free)
        open_values = scratch.write(
            drawn.select("kind", "canon").join(free, ["kind", "canon"], "left_anti"), f"open-{draw}")
        if not open_values.limit(1).count():
            return settled.drop("family")
        draw += 1


def _rendered() -> Column:
    """The surrogate in the form of the occurrence."""
    surface, made = F.col("surface"), F.col("surrogate")

    def one(i: Column) -> Column:
        c = F.substr(surface, i, F.lit(1))
        before = F.char_length(F.regexp_replace(F.substr(surface, F.lit(1), i), r"\D", ""))
        return F.when(c.rlike("[0-9]"), F.substr(made, before, F.lit(1))).otherwise(c)

    digits = F.char_length(F.regexp_replace(surface, r"\D", ""))
    filled = F.concat(
        F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(surface)), one), ""),
        F.substr(made, digits + 1, F.char_length(made)))  # a longer surrogate keeps its further digits
    def grouped(i: Column) -> Column:
        c = F.substr(surface, i, F.lit(1))
        before = F.char_length(F.regexp_replace(F.substr(surface, F.lit(1), i), " ", ""))
        return F.when(c == " ", c).otherwise(F.upper(F.substr(made, before, F.lit(1))))

    signs = F.char_length(F.regexp_replace(surface, " ", ""))
    spaced = F.concat(
        F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(surface)), grouped), ""),
        F.substr(made, signs + 1, F.char_length(made)))
    cased = (
        F.when((surface == F.upper(surface)) & (F.col("kind") != "email") & surface.rlike(r"\p{L}"), F.upper(made))
        .when(F.col("kind").rlike("^(surname|given)"), F.array_join(F.transform(F.split(made, "-"), F.initcap), "-"))
        .otherwise(made)
    )
    return (
        F.when(F.col("kind") == "title", surface)
        .when(F.col("kind").isin("phone", "card", "ssn"), filled)
        .when(F.col("kind") == "iban", spaced).otherwise(cased)
    )


def replace_values(docs: DataFrame, key: str) -> DataFrame:
    """The documents with surrogates in their texts, and ``n_entities`` (bigint) last.

    Null and empty texts stay as they are with no entity; texts without a value
    are passed on to the byte. All columns of ``docs`` are kept, whatever their
    names; repeated rows are treated alike. ``n_chars`` follows the new text.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pii")
    row = F.struct(*docs.columns).alias("row")
    source = docs.select(row, F.xxhash64("doc_id", "text").alias("uid"), F.col("text").alias("text"))
    values = scratch.write(find_values(source), "values")
    made = surrogates(values, key, scratch)
    filled = (
        values.join(made, ["kind", "canon"], "left").withColumn("new", _rendered())
        # rows equal in id and text have equal values
        .groupBy("uid", "at").agg(F.array_sort(F.collect_set(F.struct("part", "new"))).alias("parts"))
        .select("uid", "at", F.expr("array_join(transform(parts, p -> p.new), ' ')").alias("new"))
        .groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("at", "new"))).alias("made"))
    )
    filled = scratch.write(filled, "filled")
    has = F.size(_matches(F.col("text"))) > 0
    touched = source.where(has).join(filled, "uid", "left")
    pieces = F.split("text", ANY, -1)
    news = F.concat(F.expr("transform(made, m -> m.new)"), F.array(F.lit("")))
    joined = F.array_join(F.flatten(F.zip_with(pieces, news, lambda a, b: F.array(a, b))), "")
    changed = touched.select("row", joined.alias("text"), F.size("made").cast("long").alias("n"))
    same = source.where(F.coalesce(~has, F.lit(True))).select("row", "text", F.lit(0).cast("long").alias("n"))
    out = changed.unionByName(same)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text").alias(c))
        elif c == "n_chars":
            columns.append(
                F.when(F.col("n") > 0, F.char_length("text").cast(docs.schema[c].dataType)).otherwise(F.col("row.n_chars")).alias(c))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return out.select(*columns, F.col("n").alias("n_entities"))
