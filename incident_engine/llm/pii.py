"""Personal data: detected entities get keyed surrogates of the same type, gender, script and format.

Column expressions only. A surrogate is a function of a secret key, the entity's type and its canonical
form, so every mention of an entity gets the same surrogate wherever it stands (coreference), written in
the mention's own format. A name is found behind a title, and then its full form and its last name are found
everywhere in the same text without one. The table of all distinct entities is checked: a surrogate that another entity
has, or that is itself an entity of the corpus, is drawn again with the next salt (distinctness). Names are
drawn as a first name and a last name; persons of one last name share its surrogate, also where it stands
alone. Every salt adds a part to a drawn name, so there are surrogates for any number of names.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_engine.llm.batches import free_name

# Titles by gender, and pools of names by script and gender
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"),
}
NEUTRAL_TITLES = ("Dr", "Prof", "Доктор")
FIRST = {
    ("latin", "m"): "James Thomas Daniel Martin Lucas Peter Oscar Victor Simon Adrian Felix Julian Hugo Leon David Paul".split(),
    ("latin", "f"): "Mary Laura Sarah Helen Emma Clara Julia Sophie Nora Alice Irene Marta Lucia Eva Hanna Paula".split(),
    ("cyrillic", "m"): "Иван Пётр Алексей Сергей Николай Олег Павел Михаил".split(),
    ("cyrillic", "f"): "Мария Анна Ольга Елена Ирина Наталья Вера Дарья".split(),
    ("greek", "m"): "Γιώργος Νίκος Πέτρος Ανδρέας".split(),
    ("greek", "f"): "Μαρία Ελένη Άννα Σοφία".split(),
}
LAST = {
    "latin": "Keller Morris Vargas Dupont Lindner Carver Moreno Girard Holst Pereira Bellamy Novak Fontaine Ritter Salas Whitby".split(),
    "cyrillic": "Крамер Белых Шевченко Гринько Черных Бондаренко Долгих Коваленко".split(),
    "greek": "Δούκα Μελά Βαρδή Ρήγα".split(),
}

_TITLE = "|".join([*TITLES["m"], *TITLES["f"], *NEUTRAL_TITLES])
#: A part of a name, without the ending of a possessive.
_WORD = r"\p{Lu}(?:\p{L}|-(?=\p{L})|['’](?=\p{L}{2}))+"
#: Detectors by type, tried in this order at every place of a text.
DETECTORS = {
    "email": r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9](?:[A-Za-z0-9.\-]*[A-Za-z0-9])?\.[A-Za-z]{2,}",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16}|(?:sk|pk|ghp|xox[abp])[_\-][A-Za-z0-9_\-]{16,})(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}(?![0-9])(?!\.[0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?(?:[0-9]{2,4}(?:[ .\-]?[0-9]{2,4}){1,4}|[0-9](?:[ .\-][0-9]{2,4}){2,5})(?![0-9])|(?<![0-9(])\([0-9]{3}\) ?[0-9]{3}[.\-][0-9]{4}(?![0-9])|(?<![0-9.\-])[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ \-]?[0-9]{4}){2}[ \-]?[0-9]{1,7}(?![0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "name": rf"(?<!\p{{L}})(?:{_TITLE})\.? {_WORD}(?: {_WORD})?",
}
ANY = "|".join(f"(?:{p})" for p in DETECTORS.values())
#: By type, what every match of the detector contains: a text without any of these holds no entity.
HINTS = {
    "email": "@",
    "secret": r"[0-9a-fA-F]{32}|AKIA[0-9A-Z]|(?:sk|pk|ghp|xox[abp])[_\-]",
    "ip": r"[0-9]\.[0-9]",
    "iban": "[A-Z]{2}[0-9]{2}",
    "phone": r"\+[0-9]|[0-9]{3}",
    "card": "[0-9]{4}",
    "ssn": "[0-9]{3}-",
    "name": rf"(?:{_TITLE})\.? \p{{Lu}}",
}
HINT = "|".join(HINTS[k] for k in DETECTORS)
#: Draws without any success after which entities of a fixed format have no free surrogate left.
ROUNDS = 12


def bare(mention: Column) -> Column:
    """A mention of a name without its title."""
    return F.regexp_replace(mention, rf"^(?:{_TITLE})\.? ", "")


def pattern(text: Column) -> Column:
    """The pattern of all entities of a text: the detectors, then the names they find without their titles.

    The names are looked for as they stand, in capitals and with initials, in full and as the last name.
    """
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    full = F.transform(F.filter(found, lambda m: m.rlike(rf"^(?:{DETECTORS['name']})$")), bare)
    names = F.concat(full, F.transform(full, lambda n: F.substring_index(n, " ", -1)))
    names = F.array_distinct(F.concat(names, F.transform(names, F.upper), F.transform(names, F.initcap)))
    longest = F.transform(F.array_sort(F.transform(names, lambda n: F.struct((-F.length(n)).alias("size"), n.alias("name")))), lambda x: x["name"])
    again = F.concat(F.lit(rf"{ANY}|(?<!\p{{L}})(?<!\p{{L}}['’\-])(?:"), F.array_join(longest, "|"), F.lit(r")(?!['’\-]?\p{L}{2}|\p{L})"))
    named = text.rlike(HINTS["name"])
    return F.when(named & (F.size(longest) > 0), again).otherwise(F.lit(ANY))


def mentions(text: Column) -> Column:
    """All mentions in page order; an empty array where there are none, also for a null."""
    plain = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    found = F.when(text.rlike(HINTS["name"]), F.regexp_extract_all(text, pattern(text), F.lit(0))).otherwise(plain)
    return F.when(text.rlike(HINT), found).otherwise(F.array().cast("array<string>"))


def entity_type(mention: Column) -> Column:
    """The first type whose detector matches the whole mention; a name without its title has none."""
    kinds = [F.when(mention.rlike(rf"^(?:{p})$"), F.lit(k)) for k, p in DETECTORS.items()]
    untitled = F.when(mention.rlike(rf"^{_WORD}(?: {_WORD})?$"), "name")
    return F.coalesce(*kinds, untitled, F.lit("secret"))


def canonical(kind: Column, mention: Column) -> Column:
    """What mentions of one entity have in common: letters and digits in lower case, without a title."""
    plain = F.lower(F.regexp_replace(mention, r"[^\p{L}0-9]", ""))
    name = F.lower(bare(mention))
    return F.when(kind.isin("email", "ip"), F.lower(mention)).when(kind == "name", name).otherwise(plain)


def title_gender(mention: Column) -> Column:
    title = F.regexp_extract(mention, rf"^({_TITLE})\.? ", 1)
    return F.when(title.isin(*TITLES["m"]), "m").when(title.isin(*TITLES["f"]), "f").otherwise("")


def script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, 2 * i + 1, F.lit(2)), 16, 10).cast("int")


def _of(choices: str | list[str], value: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (value % len(choices) + 1).cast("int"))


def _drawn(pool: Column, stream: Column, at: int, salt: Column, own: Column) -> Column:
    """A name of salt + 1 parts by the bytes from `at` on; the first part is never `own`."""

    def part(i: Column) -> Column:
        nth = lambda k: F.element_at(pool, (k % F.size(pool) + 1).cast("int"))
        value = _byte(stream, i + at)
        return F.when(F.lower(nth(value)) == own, nth(value + 1)).otherwise(nth(value))

    return F.array_join(F.transform(F.sequence(F.lit(0), salt), part), "-")


def _names(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _redraw(plain: Column, stream: Column, letters: str) -> Column:
    """Each digit becomes a digit and each ASCII letter one of `letters`; other characters stay."""
    chars = F.split(plain, "")
    new = F.transform(
        chars,
        lambda c, i: F.when(c.rlike("[0-9]"), (_byte(stream, i) % 10).cast("string")).when(c.rlike("[a-z]"), _of(letters, _byte(stream, i))).otherwise(c),
    )
    return F.array_join(new, "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits, the last one counting once."""
    n = F.length(digits)
    values = F.transform(F.split(digits, ""), lambda c, i: F.when((n - i) % 2 == 1, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def iban_rest(account: Column) -> Column:
    """An IBAN without separators modulo 97, letters counting 10 to 35 and its first four characters last; 1 if valid."""
    turned = F.lower(F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4)))
    step = lambda a, c: F.when(c.rlike("[0-9]"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 87) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def surrogate(key: str, kind: Column, entity: Column, gender: Column, salt: Column) -> Column:
    """The canonical surrogate of a canonical entity, by key and salt.

    Domains keep their last label and a reserved `example` label, numbers their leading country code or
    network digit, valid card numbers and IBANs stay valid, and names are drawn by gender and script, never the own: kind
    "last" is a last name, and "first" the first name of a full name.
    """
    seed = F.concat_ws("\x1f", F.lit(key), kind, entity, salt.cast("string"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.length(entity) + salt + 2) / 32).cast("int")), lambda b: F.sha2(F.concat_ws("\x1f", seed, b.cast("string")), 256))
    stream = F.array_join(blocks, "")
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    tail = F.regexp_extract(entity, r"((?:\.example)?\.[a-z]{2,})$", 1)
    email = F.concat(_redraw(F.substring(entity, F.lit(1), F.length(entity) - F.length(tail)), stream, alphabet), tail)
    ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(stream, i) % 254 + 1).cast("string")), ".")
    tied = lambda n, letters=alphabet: F.concat(F.substring(entity, 1, n), _redraw(F.substring(entity, F.lit(n + 1), F.length(entity)), stream, letters))
    card = tied(1)
    open_card = F.concat(F.substring(card, F.lit(1), F.length(card) - 1), F.lit("0"))
    checked = F.concat(F.substring(card, F.lit(1), F.length(card) - 1), ((10 - luhn_sum(open_card) % 10) % 10).cast("string"))
    card = F.when(luhn_sum(entity) % 10 == 0, checked).otherwise(card)
    iban = tied(2)
    check = lambda digits: F.concat(F.substring(iban, 1, 2), digits, F.substring(iban, F.lit(5), F.length(iban)))
    iban = F.when(iban_rest(entity) == 1, check(F.lpad((98 - iban_rest(check(F.lit("00")))).cast("string"), 2, "0"))).otherwise(iban)
    hexed = _redraw(entity, stream, "abcdef")
    secret = F.when(entity.rlike("^[0-9a-f]+$"), hexed).otherwise(tied(4))
    drawn_gender = F.when(gender != "", gender).when(_byte(stream, F.lit(0)) % 2 == 0, "m").otherwise("f")
    firsts = F.coalesce(*[F.when((script(entity) == s) & (drawn_gender == g), _names(pool)) for (s, g), pool in FIRST.items()])
    lasts = F.coalesce(*[F.when(script(entity) == s, _names(pool)) for s, pool in LAST.items()])
    first = _drawn(firsts, stream, 1, salt, F.substring_index(entity, " ", 1))
    last = _drawn(lasts, stream, 0, salt, entity)
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "first", first).when(kind == "last", last).when(kind == "card", card)
        .when(kind == "secret", secret).when(kind == "iban", iban).when(kind == "phone", tied(1)).otherwise(_redraw(entity, stream, alphabet))
    )


def written(kind: Column, mention: Column, new: Column) -> Column:
    """The surrogate in the format of a mention: its separators, and its letter case by place."""
    chars = F.split(mention, "")
    nth = F.transform(chars, lambda c, i: F.length(F.regexp_replace(F.substring(mention, F.lit(1), i + 1), r"[^\p{L}0-9]", "")))
    plain = F.regexp_replace(new, r"[^\p{L}0-9]", "")
    placed = F.transform(
        F.arrays_zip(chars.alias("c"), nth.alias("n")),
        lambda x: F.when(~x["c"].rlike(r"[\p{L}0-9]"), x["c"]).when(x["c"].rlike(r"\p{Lu}"), F.upper(F.substring(plain, x["n"], F.lit(1)))).otherwise(F.substring(plain, x["n"], F.lit(1))),
    )
    title = F.regexp_extract(mention, rf"^((?:{_TITLE})\.? )", 1)
    own = bare(mention)
    named = F.concat(title, F.when(own == F.upper(own), F.upper(new)).otherwise(new))
    return F.when(kind == "ip", new).when(kind == "name", named).otherwise(F.array_join(placed, ""))


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """kind, entity, new for distinct (kind, entity, gender), no surrogate twice and none an entity itself."""
    entities = entities.checkpoint()
    named = F.col("kind") == "name"
    last = F.substring_index("entity", " ", -1)
    whole = entities.where(~named).withColumn("scope", F.lit(""))
    lasts = entities.where(named).select(F.lit("last").alias("kind"), last.alias("entity"), F.lit("").alias("gender"), F.lit("").alias("scope")).distinct()
    firsts = entities.where(named & F.col("entity").contains(" ")).withColumn("scope", last).withColumn("kind", F.lit("first"))
    drawn = _draw(whole.unionByName(lasts).unionByName(firsts), key)
    of = lambda kind, column, new: drawn.where(F.col("kind") == kind).select(F.col("entity").alias(column), F.col("new").alias(new))
    names = entities.where(named).withColumn("last", last).join(of("last", "last", "new_last"), "last").join(of("first", "entity", "new_first"), "entity", "left")
    names = names.select("kind", "entity", F.concat_ws(" ", "new_first", "new_last").alias("new"))
    return drawn.where(~F.col("kind").isin("first", "last")).unionByName(names)


def _draw(entities: DataFrame, key: str) -> DataFrame:
    """kind, entity, new for (kind, entity, gender, scope), no surrogate twice in a scope and none an entity itself.

    Each round draws for the entities that have none yet and keeps the draws that are free; the order of
    entities decides between two with the same draw. Names get longer with each round and so always end. Raises if
    ROUNDS rounds on end place nothing, as when a corpus fills the numbers of a fixed format.
    """
    entities = entities.checkpoint()
    real = entities.select("kind", F.col("entity").alias("lower"))
    done: list[DataFrame] = []
    left, idle = entities, 0
    for salt in count(0):
        drawn = left.withColumn("new", surrogate(key, F.col("kind"), F.col("entity"), F.col("gender"), F.lit(salt)))
        rank = F.row_number().over(Window.partitionBy("kind", "scope", "new").orderBy("entity"))
        free = drawn.withColumn("rank", rank).where("rank = 1").drop("rank")
        free = free.withColumn("lower", F.lower("new")).where("kind <> 'first' OR lower <> substring_index(entity, ' ', 1)").join(real, ["kind", "lower"], "left_anti")
        if done:
            free = free.join(reduce(DataFrame.unionByName, done).select("kind", "scope", "new"), ["kind", "scope", "new"], "left_anti")
        done.append(free.select("kind", "scope", "entity", "new").checkpoint())
        left = left.join(done[-1], ["kind", "entity"], "left_anti").checkpoint()
        if left.isEmpty():
            return reduce(DataFrame.unionByName, done).drop("scope")
        idle = idle + 1 if done[-1].isEmpty() else 0
        if idle == ROUNDS:
            raise ValueError("no free surrogate of the same format for " + ", ".join(sorted(r.kind for r in left.select("kind").distinct().collect())))


def replace(docs: DataFrame, key: str, text: str = "text", count: str = "n_replaced") -> DataFrame:
    """`docs` with surrogates in the column `text`, and the number of replaced mentions as `count`.

    Texts are looked up by their digest, so equal texts are worked on once. Null and empty texts stay as
    they are, with 0 mentions. A column called `count` that exists already makes the new one end in
    underscores. An entity named with two genders has the one that comes first in the alphabet.
    """
    count, digest, parts = free_name(docs, count), free_name(docs, "pii_digest"), free_name(docs, "pii_parts")
    found = docs.select(F.md5(text).alias("digest"), mentions(F.col(text)).alias("found")).where(F.size("found") > 0)
    rows = found.dropDuplicates(["digest"]).select("digest", F.posexplode("found").alias("at", "mention"))
    kind = entity_type(F.col("mention"))
    rows = rows.withColumn("kind", kind).withColumn("entity", canonical(F.col("kind"), F.col("mention"))).checkpoint()
    entities = rows.groupBy("kind", "entity").agg(
        F.coalesce(F.min(F.nullif(F.when(F.col("kind") == "name", title_gender(F.col("mention"))).otherwise(F.lit("")), F.lit(""))), F.lit("")).alias("gender")
    )
    new = surrogate_table(entities, key)
    filled = (
        rows.join(new, ["kind", "entity"])
        .withColumn("new", written(F.col("kind"), F.col("mention"), F.col("new")))
        .groupBy("digest")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "new"))), lambda x: x["new"]).alias("new"))
    )
    has = F.col(text).rlike(HINT) & F.col(text).rlike(ANY)
    pieces = F.when(F.col(text).rlike(HINTS["name"]), F.split(F.col(text), pattern(F.col(text)), -1)).otherwise(F.split(F.col(text), ANY, -1))
    rebuilt = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(F.col(parts), i), F.lit("")))), "")
    own = [f"`{c}`" for c in docs.columns]
    touched = (
        docs.where(has)
        .withColumn(digest, F.md5(text))
        .join(filled.select(F.col("digest").alias(digest), F.col("new").alias(parts)), digest)
        .withColumn(text, rebuilt)
        .select(*own, F.size(parts).cast("long").alias(count))
    )
    clean = docs.where(~F.coalesce(has, F.lit(False))).select(*own, F.lit(0).cast("long").alias(count))
    return touched.unionByName(clean)
