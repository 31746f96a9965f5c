"""Personal data: entities found by patterns get keyed surrogates of their type, gender, script and format."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import join_dimension
from ..sources.storage import new_folder
from .store import step

#: Attempts in an entity's own format; each further one makes the format wider.
HOT_SHARE = 0.02
MAX_ROUNDS = 100

# Patterns (Java syntax), titles, names and alphabets.
MALE_TITLES = "Mr|Mister|Herr|Señor|Sr|Monsieur|господин|κύριος"
FEMALE_TITLES = "Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|госпожа|κυρία"
START = r"(?<![\p{L}\p{N}])"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = [
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"),
    ("secret", START + r"(?:[0-9a-fA-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36})(?![\p{L}\p{N}])"),
    ("ip", r"(?<![\p{L}\p{N}.])" + OCTET + r"(?:\." + OCTET + r"){3}(?![\p{L}\p{N}]|\.\d)"),
    ("ssn", r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])"),
    ("phone", r"(?<![\p{L}\p{N}.+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?![\p{L}\p{N}])"),
    ("phone", r"(?<![\p{L}\p{N}.+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?![\p{L}\p{N}])"),
    ("phone", r"(?<![\p{L}\p{N}.-])(?:\d[.-])?\d{3}[.-]\d{3}[.-]\d{4}(?![\p{L}\p{N}-])"),
    ("iban", START + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"),
    ("card", r"(?<![\p{L}\p{N}.-])\d{4}([ -]?)\d{4}(?:[ -]?\d){5,11}(?![\p{L}\p{N}])"),
    ("person", START + f"(?:{MALE_TITLES}|{FEMALE_TITLES})" + r"\.? \p{Lu}\p{L}+(?: \p{Lu}\p{L}+)?"),
]
NAMES = {
    ("male", "latin"): "Adam Ben Carl David Emil Frank Georg Hugo Ivan Jan Karl Leo Max Nils Otto Paul",
    ("female", "latin"): "Anna Berta Clara Diana Emma Frida Greta Helena Ida Julia Karla Lena Maria Nora Olga Paula",
    ("male", "cyrillic"): "Алексей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Сергей Тимур",
    ("female", "cyrillic"): "Алла Белла Вера Галина Дарья Ева Жанна Зоя Ирина Ксения Лариса Мария Нина Ольга Полина Софья",
    ("male", "greek"): "Αλέξης Γιώργος Δημήτρης Ηλίας Θωμάς Ιάσων Κώστας Λάμπρος Μάριος Νίκος Ορέστης Παύλος Σάββας Τάσος Φίλιππος Χρήστος",
    ("female", "greek"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ηρώ Θάλεια Ιωάννα Κατερίνα Λυδία Μαρία Νεφέλη Ξένια Ολυμπία Σοφία",
}
ALPHABETS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "accented": "àáâäãåæçèéêëìíîïñòóôöõøùúûüýß",
    "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "digit": "0123456789",
}
# End of fixed values.

ANY = "|".join(f"(?:{p})" for _, p in PATTERNS).replace(r"([ -]?)\d{4}", r"[ -]?\d{4}")
#: What every entity holds one of.
HINT = rf"@|\d|{MALE_TITLES}|{FEMALE_TITLES}|[0-9a-fA-F]{{32}}|AKIA|gh[pousr]_"
TITLE = f"^(?:{MALE_TITLES}|{FEMALE_TITLES})" + r"\.? "


def _kind(found: Column) -> Column:
    result = F.lit("other")
    for kind, pattern in reversed(PATTERNS):
        result = F.when(found.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(result)
    return result


def _core(kind: Column, found: Column) -> Column:
    """What two mentions of one entity have in common: letters and digits in lower case; of a person, the name without the title."""
    name = F.regexp_replace(found, TITLE, "")
    return F.when(kind == "person", F.lower(name)).when(kind.isin("email", "ip"), F.lower(found)).otherwise(F.lower(F.regexp_replace(found, r"[^\p{L}\p{N}_]", "")))


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _digest(key: str, attempt: Column, *parts: Column) -> Column:
    """256 hexadecimal digits that only who has the key can tell."""
    return F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), *parts, attempt.cast("string"), F.lit(str(block))), 256) for block in range(4)])


def _number(digest: Column, i: Column) -> Column:
    """The i-th of 128 numbers from 0 to 255, from two digits each."""
    return F.conv(F.substr(digest, i % 128 * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(options: Column, size: int, number: Column) -> Column:
    return F.substr(options, number % size + 1, F.lit(1))


def _letters(core: Column, kept_head: Column, kept_tail: Column, digest: Column, hexadecimal: Column) -> Column:
    """Replace each letter and digit of ``core`` by one of its kind and script, but for some at both ends."""
    size = F.length(core)

    def one(char: Column, i: Column) -> Column:
        number = _number(digest, i)
        result = char
        for alphabet in reversed(ALPHABETS.values()):
            result = F.when(F.lit(alphabet).contains(char), _pick(F.lit(alphabet), len(alphabet), number)).otherwise(result)
        result = F.when(char.rlike("^[1-9]$"), (number % 9 + 1).cast("string")).otherwise(result)  # no zero in front that was not there
        result = F.when(char.rlike(r"^\p{L}$") & (result == char) & ~F.lit("".join(ALPHABETS.values())).contains(char),
                        _pick(F.lit(ALPHABETS["latin"]), 26, number)).otherwise(result)
        result = F.when(hexadecimal & char.rlike("[0-9a-f]"), _pick(F.lit("0123456789abcdef"), 16, number)).otherwise(result)
        return F.when((i < kept_head) | (i >= size - kept_tail), char).otherwise(result)

    return F.array_join(F.transform(F.filter(F.split(core, ""), lambda c: c != ""), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the check rule for card numbers, modulo 10."""
    reversed_ = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    doubled = F.transform(reversed_, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10


def _surrogate(kind: Column, core: Column, gender: Column, digest: Column) -> Column:
    """A candidate for an entity, in the form of its core."""
    n = lambda i: _number(digest, F.lit(i))
    octet = lambda part, i: (F.when(F.length(part) == 1, n(i) % 10).when(F.length(part) == 2, 10 + n(i) % 90)
                             .otherwise(100 + n(i) % 156)).cast("string")
    ip = F.concat_ws(".", *[octet(F.split_part(core, F.lit("."), F.lit(i)), i) for i in range(1, 5)])
    head = (F.when(kind == "phone", F.when(F.length(core) > 10, F.length(core) - 10).otherwise(0)).when(kind == "card", 1).when(kind == "iban", 2)
            .when((kind == "secret") & core.rlike("^gh[pousr]_|^akia"), 4).otherwise(0))
    tail = F.when(kind == "email", F.length(F.substring_index(core, ".", -1)) + 1).otherwise(0)
    hexadecimal = (kind == "secret") & core.rlike("^[0-9a-f]+$")
    plain = _letters(core, head, tail, digest, hexadecimal)
    # a check digit that leaves the card's rule as the original has it
    front = F.substr(plain, F.lit(1), F.length(plain) - 1)
    wrong = (_luhn(F.concat(front, F.lit("0"))) - _luhn(core) + 20) % 10
    card = F.concat(front, ((10 - wrong) % 10).cast("string"))
    given = F.lit(None).cast("string")
    for (g, script), names in NAMES.items():
        options = names.split()
        given = F.when((gender == g) & (_script(core) == script), F.element_at(F.array(*[F.lit(x.lower()) for x in options]), n(1) % len(options) + 1)).otherwise(given)
    family = _letters(F.substring_index(core, " ", -1), F.lit(0), F.lit(0), digest, F.lit(False))
    person = F.when(core.contains(" "), F.concat(given, F.lit(" "), family)).otherwise(family)
    return F.when(kind == "ip", ip).when(kind == "card", card).when(kind == "person", person).otherwise(plain)


def _widened(kind: Column, core: Column, extra: Column) -> Column:
    """The core as one of a wider format: address parts of three digits, else ``extra`` more letters or digits."""
    more = lambda c: F.repeat(c, extra)
    wider = (F.when(kind == "ip", F.lit("100.100.100.100")).when(kind == "email", F.concat(more(F.lit("a")), core))
             .when(kind == "person", F.concat(core, more(F.right(core, F.lit(1))))).otherwise(F.concat(core, more(F.lit("0")))))
    return F.when(extra > 0, wider).otherwise(core)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(``kind``, ``core``, ``gender``) with a ``surrogate`` each. Of entities with one candidate, and where it is itself an entity of the
    table, all but the first get the next candidate, until all surrogates differ from each other and from every entity, and family names from their own.
    A round is over those that are left, held against the surrogates that are taken. What has had no free candidate in ``MAX_ROUNDS`` attempts gets candidates of a wider format, as its own may hold no more."""
    spark, folder = entities.sparkSession, new_folder(entities.sparkSession, "taken")
    schema = "kind string, core string, gender string, surrogate string"
    # No rows, made without a Python worker, which would keep a daemon and workers of its own beside those of other stages.
    spark.range(0).selectExpr(*[f"cast(null as string) as {c.split()[0]}" for c in schema.split(", ")]).write.parquet(folder)
    real = entities.select("kind", F.col("core").alias("surrogate"), F.lit(True).alias("real")).distinct()
    same = Window.partitionBy("kind", "surrogate").orderBy("core", "gender")
    last = lambda c: F.substring_index(c, " ", -1)
    left, attempt = entities, 0
    while True:
        # The digest is stored before it is used: an expression over it would hash anew for each character.
        hashed = step(left.withColumn("digest", _digest(key, F.lit(attempt), F.col("kind"), F.col("core"))), "digests")
        form = _widened(F.col("kind"), F.col("core"), F.lit(attempt - MAX_ROUNDS + 1))
        made = step(hashed.withColumn("form", form).withColumn("surrogate", _surrogate(F.col("kind"), F.col("form"), F.col("gender"), F.col("digest")))
                    .drop("digest", "form"), "surrogates")
        taken = spark.read.schema(schema).parquet(folder).select("kind", "surrogate", F.lit(True).alias("taken"))
        same_family = (F.col("kind") == "person") & (last("surrogate") == last("core"))
        again = (F.row_number().over(same) > 1) | same_family
        judged = made.withColumn("again", again).join(real, ["kind", "surrogate"], "left").join(taken, ["kind", "surrogate"], "left")
        judged = step(judged.withColumn("again", F.col("again") | F.coalesce("real", "taken", F.lit(False))), "judged")
        judged.where("not again").select("kind", "core", "gender", "surrogate").write.mode("append").parquet(folder)
        left, attempt = judged.where("again").select("kind", "core", "gender"), attempt + 1
        if not left.limit(1).count():
            return spark.read.schema(schema).parquet(folder)


def _shaped(found: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the form of one mention: its separators, title and capitals."""
    title = F.regexp_extract(found, TITLE, 0)
    name = F.when(F.regexp_replace(found, TITLE, "").contains(" "), surrogate).otherwise(F.substring_index(surrogate, " ", -1))
    separate = r"[\p{L}\p{N}_]"
    chars = F.filter(F.split(found, ""), lambda c: c != "")
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))

    def add(state: Column, c: Column) -> Column:
        own = F.substr(surrogate, state["i"], F.lit(1))
        return F.when(c.rlike(separate), F.struct(F.concat(state["out"], F.when(c.rlike(r"\p{Lu}"), F.upper(own)).otherwise(own)).alias("out"), (state["i"] + 1).alias("i"))) \
            .otherwise(F.struct(F.concat(state["out"], c).alias("out"), state["i"].alias("i")))

    filled = F.aggregate(chars, start, add, lambda s: F.concat(s["out"], F.substr(surrogate, s["i"])))
    whole = F.when(F.lower(found) == found, surrogate).when(F.upper(found) == found, F.upper(surrogate)).otherwise(surrogate)
    return F.when(kind == "person", F.concat(title, F.initcap(name))).when(kind.isin("email", "ip"), whole).otherwise(filled)


def _gender(found: Column) -> Column:
    return F.when(found.rlike(f"^(?:{MALE_TITLES})" + r"\.? "), "male").otherwise("female")


def _people(found: Column) -> Column:
    """Who is named behind a title, full names first."""
    def one(mention: Column) -> Column:
        name = F.regexp_replace(mention, TITLE, "")
        return F.struct(name.alias("name"), F.substring_index(name, " ", -1).alias("family"), _gender(mention).alias("gender"))

    people = F.transform(F.filter(found, lambda x: x.rlike(TITLE)), one)
    return F.array_distinct(F.concat(F.filter(people, lambda p: p["name"] != p["family"]), F.filter(people, lambda p: p["name"] == p["family"])))


def _with_names(people: Column) -> Column:
    """The pattern of all entities, and of the full and family names of the people, which are only letters, without a title."""
    names = F.array_distinct(F.concat(F.transform(people, lambda p: p["name"]), F.transform(people, lambda p: p["family"])))
    ordered = F.concat(F.filter(names, lambda x: x.contains(" ")), F.filter(names, lambda x: ~x.contains(" ")))
    return F.concat(F.lit(f"{ANY}|{START}(?:"), F.array_join(ordered, "|"), F.lit(r")(?![\p{L}\p{N}])"))


def _person(mention: Column, people: Column) -> Column:
    """The one of the people whom a mention means: by the same name, or by the family name alone; where it has a title, of its gender."""
    name, bare = F.regexp_replace(mention, TITLE, ""), ~mention.rlike(TITLE)
    return F.get(F.filter(people, lambda p: ((p["name"] == name) | (p["family"] == name)) & (bare | (p["gender"] == _gender(mention)))), F.lit(0))


def replace_entities(docs: DataFrame, key: str, text: str = "text", with_count: bool = False) -> DataFrame:
    """The rows with every entity of ``text`` replaced; other columns stay, and with ``with_count`` a column
    ``n_entities`` is added (in the place of one of that name). Texts without entities, nulls and empty ones come back as they are, without a shuffle.

    A person is found behind a title; the full and the family name are then found again in the same text, with or without one, and
    mean the same person (of several of one family name, the first with a full name). A name that has no title anywhere in its
    text, or a given name alone, is not found.

    One entity (a person's name, an address in any case, the digits of a number with any separators) has one
    surrogate in the whole table, and no two entities share one; where a format has too few values for all, some get a longer one. Surrogates depend on the key: whoever lacks it can't tie them to
    what they stand for. They keep what makes the type: separators and capitals, top-level domains, country
    codes, digits per address part, the check rule of card numbers, title and gender and script of names.
    """
    spark = docs.sparkSession
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("body"))
    found = F.when(F.col("body").rlike(HINT), F.regexp_extract_all("body", F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    marked = whole.withColumn("found", F.coalesce(found, F.array().cast("array<string>")))
    marked = marked.withColumn("people", _people(F.col("found")))
    count = [F.lit(0).cast("long").alias("n_entities")] if with_count else []
    own = [F.col(f"row.`{c}`") for c in docs.columns if not (with_count and c == "n_entities")]
    plain = marked.where(F.size("found") == 0).select(*own, *count)
    with_names, some = _with_names(F.col("people")), F.size("people") > 0
    held = step(marked.where(F.size("found") > 0).withColumns({
        "number": F.monotonically_increasing_id(), "found": F.when(some, F.regexp_extract_all("body", with_names, F.lit(0))).otherwise(F.col("found")),
        "between": F.when(some, F.split("body", with_names, -1)).otherwise(F.split("body", ANY, -1))}).drop("body"), "held")
    each = held.select("number", "people", F.posexplode("found").alias("place", "mention"))
    each = each.withColumn("kind", _kind(F.col("mention")))
    each = each.withColumn("person", F.when(F.col("kind").isin("person", "other"), _person(F.col("mention"), F.col("people")))).drop("people")
    each = each.withColumn("kind", F.when(F.col("person").isNotNull(), "person").otherwise(F.col("kind")))
    each = each.withColumn("core", F.coalesce(F.lower("person.name"), _core(F.col("kind"), F.col("mention"))))
    gender = F.when(F.col("kind") != "person", "").otherwise(F.coalesce("person.gender", _gender(F.col("mention"))))
    each = each.withColumn("gender", gender).drop("person")
    given = assign(step(each.select("kind", "core", "gender").distinct(), "entities"), key)
    entity = F.struct("kind", "core", "gender")
    each, given = each.withColumn("entity", entity), given.withColumn("entity", entity)
    # One address may be a third of all mentions: those of hot entities are dealt over several tasks.
    met = join_dimension(each, given, "entity", "entity", ["surrogate"], hot_share=HOT_SHARE)
    shaped = met.select("number", "place", _shaped(F.col("mention"), F.col("kind"), F.col("surrogate")).alias("new"))
    lists = shaped.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("place", "new"))).alias("new"))
    joined = held.join(lists, "number").withColumn("new", F.col("new.new"))
    pieces = F.zip_with("between", F.concat("new", F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    rows = joined.select(F.col("row").withField(f"`{text}`", F.array_join(pieces, "")).alias("row"), F.size("new").cast("long").alias("n_entities"))
    return plain.unionByName(rows.select(*own, *([F.col("n_entities")] if with_count else [])))


def op2_surrogates(spark, sf_dir: str) -> DataFrame:
    """All documents with surrogates in the place of personal data."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return replace_entities(docs, key="a key of the session", with_count=True).select("doc_id", "text", "n_entities")
