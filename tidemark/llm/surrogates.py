"""Personal data and secrets replaced by keyed surrogates, with DataFrame functions only.

An entity is a kind and a canonical spelling, so every way to write it gets the same surrogate, in this
document and in all others. A surrogate keeps the kind, length, punctuation, script and case of what it
stands for; given names stay in their gender and script. Surrogates come from keyed digests. They are
checked against each other and against all entities of the corpus, and drawn again until no two entities
share one and none is a true value. Entities that fill much of what their form allows get theirs from a
list of all its values in an order that the key decides, so that they stay distinct however full it is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shingles import small
from tidemark.llm.tables import settled

# Titles and given names that mark persons, by script and gender.
TITLES = (
    "Mr", "Mrs", "Ms", "Miss", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Señora", "Sr", "Sra",
    "господин", "госпожа", "г-н", "г-жа",
)
GIVEN_NAMES = {
    ("latin", "female"): (
        "Alice", "Anna", "Carla", "Clara", "Elena", "Emma", "Julia", "Laura", "Lucia", "Maria", "Mary", "Sarah",
        "Sophie", "Susan",
    ),
    ("latin", "male"): (
        "Bob", "Carlos", "David", "Hans", "James", "John", "Jose", "Michael", "Paul", "Peter", "Pierre", "Robert",
        "Thomas", "William",
    ),
    ("cyrillic", "female"): ("Анна", "Елена", "Мария", "Наталья", "Ольга", "Светлана"),
    ("cyrillic", "male"): ("Андрей", "Дмитрий", "Иван", "Николай", "Пётр", "Сергей"),
}
ALPHABETS = {
    "digit": "0123456789",
    "hex": "0123456789abcdef",
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзийклмнопрстуфхцчшщыэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}
SYLLABLES = {
    "latin": ("ba", "den", "fel", "gor", "hal", "kin", "lor", "mar", "nev", "pol", "ris", "sten", "tor", "ul", "ven", "zan"),
    "cyrillic": ("ба", "вин", "гор", "дан", "кин", "лев", "мар", "нов", "пол", "рис", "сан", "тор", "ул", "фен", "шин", "яр"),
}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_NAME = r"\p{Lu}\p{Ll}++(?:-\p{Lu}\p{Ll}++)?"
_GIVEN = "|".join(name for names in GIVEN_NAMES.values() for name in names)
_EMAIL = r"[\p{L}\p{N}][\p{L}\p{N}._%+\-]*+@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)+"
_KEYED = (
    r"(?=[A-Za-z0-9_+/\-]{16})(?<=(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key) ?[:=] ?[\"']?)"
    r"[A-Za-z0-9_+/\-]{16,}+=*"
)
_HEX = r"[0-9a-fA-F]{32,}+(?![\p{L}\p{N}])"
_IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
_IP = rf"{_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)"
_CARD = r"(?:\d{13,19}|\d{4}(?:-\d{4}){2}-\d{1,7}|\d{4}(?: \d{4}){3})(?!\d)"
_SSN = r"\d{3}-\d{2}-\d{4}(?!\d)"
_PHONE = r"(?:\+\d{1,3}(?:[ .\-]?\(?\d{2,4}\)?){2,5}|\(?\d{3}\)?[ .\-]\d{3}[ .\-]\d{4})(?!\d)"
_PERSON = rf"(?=\p{{Lu}}|г)(?:(?:{'|'.join(TITLES)})\.? {_NAME}(?: {_NAME})?|(?:{_GIVEN}) {_NAME})"
ENTITY = "(?<![\\p{L}\\p{N}])(?:" + "|".join((_EMAIL, _KEYED, _HEX, _IBAN, _IP, _CARD, _SSN, _PHONE, _PERSON)) + ")"

# Places of a form that are drawn anew: what its mark may become. All other characters stay.
_DIGIT, _HEX_DIGIT, _LATIN, _CYRILLIC, _GREEK, _NUMBER, _RIGHT, _WRONG = map(chr, range(1, 9))
# Forms with fewer values than this for each of their entities are listed, others are drawn from: a draw
# then fails one time in four at most.
ROOMY = 8
# Values that one row is unfolded to.
_LISTED = 1 << 16


def with_surrogates(documents: DataFrame, key: str) -> DataFrame:
    """``documents`` with the entities in ``text`` replaced, and their number as ``n_replaced``.

    Emails, secrets, IBANs, IPv4 addresses, card, social security and phone numbers and names of persons are
    entities. All other characters stay as they are, as do rows without entities and NULL texts (with 0).
    Very long texts are searched whole; repeated rows come out alike; other columns are kept. The same key
    gives the same surrogates over the same corpus.

    No two entities of a kind share a surrogate. None is a true value, unless entities are more than half of
    all values of a form: then those left over get true values of others, and only the one entity of a form
    with a single value keeps its own.
    """
    columns = [name for name in documents.columns if name != "n_replaced"]
    keyed = documents.select(*[F.col(f"`{name}`") for name in columns], F.md5("text").alias("_text_key"))
    parts = settled(_parts(keyed), "parts")
    known = _mapping(parts.where("value is not null").select("kind", "value").distinct(), key)
    rendered = parts.join(known, ["kind", "value"], "left").select(
        "text_key", "pos", "part", F.concat(F.when(F.col("part") > 0, " ").otherwise(""), _rendered(key)).alias("out")
    )
    lists = rendered.groupBy("text_key").agg(
        F.collect_list(F.struct("pos", "part", "out")).alias("_parts"),
        (F.max("pos") + 1).alias("_entities"),
    )
    lists = settled(lists, "lists")
    # Only texts that hold an entity are shuffled, unless these are too many to be known everywhere.
    holding = small(lists.select("text_key"))
    same = F.col("_text_key") == F.col("text_key")
    kept = [F.col(f"`{name}`") for name in columns]
    clean = keyed.join(holding, same, "left_anti").select(*kept, F.lit(0).alias("n_replaced"))
    gaps = F.transform(
        F.split("text", ENTITY, -1),
        lambda gap, at: F.struct(at.alias("pos"), F.lit(-1).alias("part"), gap.alias("out")),
    )
    text = F.array_join(F.transform(F.sort_array(F.concat("_parts", gaps)), lambda piece: piece["out"]), "")
    replaced = keyed.join(holding, same, "left_semi").join(lists, same).select(
        *[text.alias("text") if name == "text" else F.col(f"`{name}`") for name in columns],
        F.col("_entities").alias("n_replaced"),
    )
    return clean.unionByName(replaced)


def _parts(keyed: DataFrame) -> DataFrame:
    """The parts of all entities of each distinct text; a person's name has several, all others one."""
    mentions = keyed.select(
        F.col("_text_key").alias("text_key"),
        F.posexplode(F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0))).alias("pos", "mention"),
    ).distinct()
    mention = F.col("mention")
    kind = (
        F.when(mention.contains("@"), "email")
        .when(mention.rlike(f"^{_IBAN}$"), "iban")
        .when(mention.rlike(f"^{_IP}$"), "ip")
        .when(mention.rlike(f"^{_SSN}$"), "ssn")
        .when(mention.rlike(f"^{_CARD}$"), "card")
        .when(mention.rlike(f"^{_PHONE}$"), "phone")
        .when(mention.rlike("^[0-9a-fA-F]+$"), "hex")
        .when(mention.rlike(f"^{_PERSON}$"), "person")
        .otherwise("secret")
    )
    split = mentions.withColumn("kind", kind).select(
        "text_key",
        "pos",
        F.col("kind").alias("whole"),
        F.posexplode(F.when(F.col("kind") == "person", F.split("mention", " ")).otherwise(F.array("mention"))).alias(
            "part", "written"
        ),
    )
    written = F.col("written")
    part_kind = (
        F.when(F.col("whole") != "person", F.col("whole"))
        .when(F.regexp_replace(written, r"\.$", "").isin(*TITLES), "title")
        .when(written.isin(*[name for names in GIVEN_NAMES.values() for name in names]), "given")
        .otherwise("surname")
    )
    plain = F.lower(written)
    value = (
        F.when(F.col("kind").isin("title", "given"), F.lit(None).cast("string"))
        .when(F.col("kind").isin("card", "ssn", "iban"), F.regexp_replace(plain, "[^0-9a-z]", ""))
        .when(F.col("kind") == "phone", F.regexp_replace(plain, "[^0-9+]", ""))
        .otherwise(plain)
    )
    return split.withColumn("kind", part_kind).select("text_key", "pos", "part", "kind", "written", value.alias("value"))


def _mapping(entities: DataFrame, key: str) -> DataFrame:
    """A surrogate for every (kind, value): no two of a kind share one, and none is an entity itself.

    Values of different forms differ, so every form is seen to by itself.
    """
    entities = settled(_with_form(entities), "entities")
    full = entities.groupBy("kind", "form", "room").agg(F.count(F.lit(1)).alias("members"))
    full = settled(full.where(F.col("room") < F.col("members") * ROOMY), "full")
    some = not full.isEmpty()
    tight = small(full.select("kind", "form")) if some else full
    taken = entities.select("kind", F.col("value").alias("surrogate"))
    pending = entities.join(tight, ["kind", "form"], "left_anti") if some else entities
    accepted = [_listed(entities.join(tight, ["kind", "form"], "left_semi"), taken, full, key)] if some else []
    draw = 0
    while not pending.isEmpty():
        drawn = _with_digest(pending, key, draw).withColumn("surrogate", _surrogate(draw))
        first = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("value")) == 1
        used = reduce(DataFrame.union, [part.select("kind", "surrogate") for part in accepted], taken)
        checked = drawn.withColumn("first", first).join(
            used.distinct().withColumn("used", F.lit(True)), ["kind", "surrogate"], "left"
        )
        good = F.col("first") & F.col("used").isNull()
        checked = settled(checked.select("kind", "value", "form", "surrogate", good.alias("good")), "drawn")
        accepted.append(checked.where("good").select("kind", "value", "surrogate"))
        pending = settled(checked.where("not good").select("kind", "value", "form"), "pending")
        draw += 1
    return reduce(DataFrame.union, accepted, entities.select("kind", "value").limit(0).withColumn("surrogate", F.lit("")))


def _listed(entities: DataFrame, taken: DataFrame, full: DataFrame, key: str) -> DataFrame:
    """Surrogates of all entities of full forms: the n-th entity of a form gets the n-th of its free values.

    Where these run out, the n-th gets the true value of the next one, and the last that of the first.
    """
    blocks = full.select(
        "kind", "form", "room", F.explode(F.sequence(F.lit(0), F.floor((F.col("room") - 1) / _LISTED).cast("int"))).alias("block")
    ).repartition("kind", "form", "block")
    begin = F.col("block").cast("long") * _LISTED
    end = F.least(begin + _LISTED, F.col("room").cast("long")) - 1
    values = blocks.select("kind", "form", F.explode(F.sequence(begin, end)).alias("number"))
    free = values.select("kind", "form", _numbered().alias("surrogate")).join(taken, ["kind", "surrogate"], "left_anti")
    owners = settled(_ranked(entities.select("kind", "form", "value"), "value", key), "owners")
    given = owners.join(_ranked(free, "surrogate", key), ["kind", "form", "rank"], "left")
    members = small(full.select("kind", "form", "members"))
    others = owners.select("kind", "form", F.col("rank").alias("next"), F.col("value").alias("other"))
    left = (
        given.where("surrogate is null")
        .join(members, ["kind", "form"])
        .withColumn("next", F.col("rank") % F.col("members") + 1)
        .join(others, ["kind", "form", "next"])
    )
    return settled(
        given.where("surrogate is not null")
        .select("kind", "value", "surrogate")
        .union(left.select("kind", "value", F.col("other").alias("surrogate"))),
        "listed",
    )


def _ranked(rows: DataFrame, name: str, key: str) -> DataFrame:
    """The rows of every form, numbered from 1 in an order that the key decides; no task holds a form whole."""
    place = F.sha2(F.concat_ws("|", F.lit(key), F.lit(name), "kind", name), 256)
    placed = rows.withColumns({"place": place, "slice": F.substring(place, 1, 4)})
    form = Window.partitionBy("kind", "form")
    sizes = placed.groupBy("kind", "form", "slice").agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(form.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("kind", "form", "slice").orderBy("place", name))
    offsets = sizes.select("kind", "form", "slice", before.alias("before"))
    numbered = placed.withColumn("inside", inside).join(offsets, ["kind", "form", "slice"])
    return numbered.select("kind", "form", name, (F.col("before") + F.col("inside")).alias("rank"))


def _with_form(entities: DataFrame) -> DataFrame:
    """Entities with the form that their surrogates have and ``room``, the number of values of that form.

    A form is the value with a mark in each place that is drawn anew. Surnames have no form and no end of
    values, since each draw takes one syllable more.
    """
    kind, value = F.col("kind"), F.col("value")
    tail = F.length("value") - F.length(F.regexp_extract("value", r"\.[^.]*$", 0))

    def mark(char: Column, at: Column) -> Column:
        fixed = (
            ((kind == "phone") & (at == 1) & value.startswith("+"))
            | ((kind == "card") & (at == 0))
            | ((kind == "iban") & (at < 2))
            | ((kind == "email") & (at >= tail))
        )
        return (
            F.when(fixed, char)
            .when((kind == "hex") & char.rlike("[0-9a-f]"), _HEX_DIGIT)
            .when(char.rlike("[0-9]"), _DIGIT)
            .when(char.rlike(r"\p{IsCyrillic}"), _CYRILLIC)
            .when(char.rlike(r"\p{IsGreek}"), _GREEK)
            .when(char.rlike(r"\p{L}"), _LATIN)
            .otherwise(char)
        )

    marked = F.array_join(F.transform(F.split("value", ""), mark), "")
    # The last digit of a card stays a right or a wrong check digit.
    check = F.when(_luhn(value) == 0, _RIGHT).otherwise(_WRONG)
    form = (
        F.when(kind == "surname", "")
        .when(kind == "ip", ".".join(_NUMBER * 4))
        .when(kind == "card", F.concat(marked.substr(F.lit(1), F.length(value) - 1), check))
        .otherwise(marked)
    )
    room = F.aggregate(F.split("form", ""), F.lit(1.0), lambda total, char: total * _choices(char))
    formed = entities.withColumn("form", form)
    return formed.withColumn("room", F.when(kind == "surname", F.lit(float("inf"))).otherwise(room))


def _alphabets() -> dict[str, str]:
    named = zip((_DIGIT, _HEX_DIGIT, _LATIN, _CYRILLIC, _GREEK), ("digit", "hex", "latin", "cyrillic", "greek"))
    # Check digits are held by how far they are from the right one.
    return {mark: ALPHABETS[name] for mark, name in named} | {_RIGHT: "0", _WRONG: "123456789"}


def _choices(char: Column) -> Column:
    """How many values a place of a form can take."""
    sizes = {mark: len(alphabet) for mark, alphabet in _alphabets().items()} | {_NUMBER: 254}
    return reduce(lambda rest, mark: F.when(char == mark, sizes[mark]).otherwise(rest), sizes, F.lit(1))


def _put(char: Column, number: Column) -> Column:
    """A place of a form, filled as a number decides."""
    rest = F.when(char == _NUMBER, (number % 254 + 1).cast("string")).otherwise(char)
    for mark, alphabet in _alphabets().items():
        rest = F.when(char == mark, _pick(alphabet, number)).otherwise(rest)
    return rest


def _numbered() -> Column:
    """The value of a form that has a number, of all from 0 to its room."""

    def step(state: Column, char: Column) -> Column:
        digit = state["rest"] % _choices(char)
        rest = ((state["rest"] - digit) / _choices(char)).cast("long")
        return F.struct(rest.alias("rest"), F.concat(state["out"], _put(char, digit)).alias("out"))

    start = F.struct(F.col("number").cast("long").alias("rest"), F.lit("").alias("out"))
    return _checked(F.aggregate(F.split("form", ""), start, step, lambda state: state["out"]))


def _checked(filled: Column) -> Column:
    """A filled form; the last digit of a card is counted from the check digit that would be right."""
    body = filled.substr(F.lit(1), F.length(filled) - 1)
    right = (F.lit(10) - _luhn(F.concat(body, F.lit("0")))) % 10
    last = (right + filled.substr(F.length(filled), F.lit(1)).try_cast("int")) % 10
    return F.when(F.col("kind") == "card", F.concat(body, last.cast("string"))).otherwise(filled)


def _number(digest: Column, at: Column) -> Column:
    """The number, 0 to 255, that the digest has for a place."""
    start = (at * 2) % 256 + 1
    return F.conv(digest.substr(start, F.lit(2)), 16, 10).cast("int")


def _pick(alphabet: str, number: Column) -> Column:
    return F.lit(alphabet).substr((number % len(alphabet) + 1).cast("int"), F.lit(1))


def _with_digest(entities: DataFrame, key: str, draw: int) -> DataFrame:
    """Entities with the keyed digest of a draw, as hex digits."""
    seed = F.concat_ws("|", F.lit(key), F.lit(str(draw)), "kind", "value")
    return entities.withColumn("digest", F.concat(F.sha2(F.concat(seed, F.lit("|0")), 512), F.sha2(F.concat(seed, F.lit("|1")), 512)))


def _surrogate(draw: int) -> Column:
    """The canonical surrogate of an entity (kind, value, form, digest) in one draw."""
    kind, value, digest = F.col("kind"), F.col("value"), F.col("digest")
    filled = F.array_join(F.transform(F.split("form", ""), lambda char, at: _put(char, _number(digest, at))), "")

    def surname(script: str) -> Column:
        listed = F.array(*map(F.lit, SYLLABLES[script]))
        parts = [F.element_at(listed, _number(digest, F.lit(n)) % 16 + 1) for n in range(4 + draw)]
        return F.concat(*parts)

    return (
        F.when((kind == "surname") & value.rlike(r"\p{IsCyrillic}"), surname("cyrillic"))
        .when(kind == "surname", surname("latin"))
        .otherwise(_checked(filled))
    )


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10."""
    reverse = F.split(F.reverse(digits), "")

    def weighted(char: Column, at: Column) -> Column:
        number = F.coalesce(char.try_cast("int"), F.lit(0))
        double = number * 2
        return F.when(at % 2 == 0, number).otherwise(F.when(double > 9, double - 9).otherwise(double))

    return F.aggregate(F.transform(reverse, weighted), F.lit(0), lambda total, one: total + one) % 10


def _rendered(key: str) -> Column:
    """A part written with its surrogate in the form of the original."""
    written, surrogate, kind = F.col("written"), F.col("surrogate"), F.col("kind")
    chars = F.split("written", "")
    aligned = F.length("written") == F.length("surrogate")
    dense = F.when(kind == "phone", "[0-9+]").otherwise("[0-9A-Za-z]")

    def put(char: Column, at: Column) -> Column:
        place = F.when(aligned, at + 1).otherwise(
            F.length(written.substr(F.lit(1), at + 1)) - F.length(F.regexp_replace(written.substr(F.lit(1), at + 1), dense, ""))
        )
        new = surrogate.substr(place, F.lit(1))
        upper_char = (F.upper(char) == char) & (F.lower(char) != char)
        return F.when(char.rlike(r"[\p{L}\p{N}]"), F.when(upper_char, F.upper(new)).otherwise(new)).otherwise(char)

    upper = F.upper(written) == written
    put_together = F.array_join(F.transform(chars, put), "")
    formed = F.when(upper, F.upper(put_together)).otherwise(put_together)
    named = F.when(upper, F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return (
        F.when(kind == "title", written)
        .when(kind == "given", _given(written, key))
        .when(kind == "surname", named)
        .when(kind == "ip", surrogate)
        .otherwise(formed)
    )


def _given(name: Column, key: str) -> Column:
    """A given name's surrogate: the next one in an order of its list that the key decides."""
    result = name
    for names in GIVEN_NAMES.values():
        order = F.transform(
            F.array_sort(F.transform(F.array(*map(F.lit, names)), lambda one: F.struct(F.sha2(F.concat(F.lit(key), one), 256).alias("rank"), one.alias("name")))),
            lambda one: one["name"],
        )
        at = F.array_position(order, name)
        result = F.when(name.isin(*names), F.element_at(order, (at % len(names) + 1).cast("int"))).otherwise(result)
    return result
