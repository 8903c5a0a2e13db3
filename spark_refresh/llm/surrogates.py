"""Personal data replaced by keyed surrogates of the same type and form, with built-in functions only.

Entities are found by patterns: e-mail addresses, IPv4 and IPv6 addresses, telephone numbers,
payment card numbers (13 to 19 digits, alone or in a usual grouping, whose check digit holds),
social security numbers, account numbers (IBAN), assigned secrets (quoted, or unquoted with a
digit), and names after a form of address or after "name is". A name found so is replaced
wherever its document repeats it in full, also without the form of address. Other names are
not found: that would take a model. Each entity gets the surrogate that a keyed hash chooses:
digits stay digits, letters stay letters of the same case and script, groupings stay, an IPv4
part stays within 0 to 255, a name keeps the gender of its form of address. The same entity has the same surrogate in every document; two entities
never share one and no surrogate is an entity that occurs, which is checked by grouping: the
surrogates that collide are drawn again, the first of them (by hash) keeps its own. Where a form
is so crowded that draws keep colliding, the surrogate gets longer, so all are distinct in the end.

Null texts stay null, empty ones empty. Overlapping finds are settled by the pattern's
order, leftmost first. Repeated rows are treated alike. Null ids are kept: rows are joined
with their surrogates by the text's entities, not by id. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored

LONGER = 6  # attempts after which a surrogate grows, by a character each
#: Each kind and its pattern, in order of preference.
KINDS = {
    "email": r"(?<![\p{L}\p{N}_%+-])[\p{L}\p{N}_%+-]+(?:\.[\p{L}\p{N}_%+-]+)*@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "secret": r"(?<=[\"'])(?=[^\s\"']{12})(?<=(?i:token|secret|password|passwd|api_key|apikey|key)[\"']? ?[=:] ?[\"'])[\p{L}\p{N}_+/=-]{12,}(?=[\"'])|(?<=[=: ])(?=[^\s\"']{0,40}\d)(?=[^\s\"']{12})(?<=(?i:token|secret|password|passwd|api_key|apikey) ?[=:] ?)[\p{L}\p{N}_+/=-]{12,}|\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\b(?:ghp|gho|ghs)_[A-Za-z0-9]{30,}|\bsk-[A-Za-z0-9-]{20,}",
    "iban": r"(?=[A-Z]{2}\d)(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "card": r"(?=\d{4})(?<![\p{L}\p{N}.-])(?:(?:\d{4}[ -]?){3}\d{4}(?:[ -]?\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{13,15})(?![\p{L}\p{N}]|[.-]\d)",
    "phone": r"(?=[+(\d])(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?\(\d{1,4}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}|\(\d{2,4}\) ?\d{3,4}[ .-]?\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4}|\b0\d{2,4}[ /-]\d{3,4}[ -]?\d{3,5})(?![\p{L}\p{N}])",
    "ssn": r"(?=\d{3}-)(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "ip": r"(?=\d{1,3}\.\d)(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)",
    "ipv6": r"(?=[0-9A-Fa-f]{1,4}:)(?<![\p{L}\p{N}:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])",
    "name_m": r"(?<= )(?=\p{Lu})(?<=\b(?:Mr|Mr\.|Sir|Herr|Herrn|Monsieur|Señor|Sr\.) )\p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+){0,2}",
    "name_f": r"(?<= )(?=\p{Lu})(?<=\b(?:Mrs|Mrs\.|Ms|Ms\.|Miss|Madam|Frau|Madame|Mme|Señora|Sra\.) )\p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+){0,2}",
    "name": r"(?<= )(?=\p{Lu})(?<=\b(?:Dr|Dr\.|Prof|Prof\.|Professor|Doctor|name is) )\p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+){0,2}",
}
#: Syllables of given names by gender and of other names; a surrogate name is made of them.
ENDINGS = {"name_m": ("on", "us", "or", "im", "ed", "ar", "el", "as"), "name_f": ("a", "ia", "elle", "ina", "ira", "ea", "isa", "ora"), "name": ("in", "en", "is", "an", "yn", "em", "il", "al")}
SYLLABLES = tuple(c + v for c in "bdfghklmnprstvz" for v in "aeiou") + tuple(c + v + d for c in "bdklmnrt" for v in "aeiou" for d in "lnrs")
CYRILLIC = tuple(c + v for c in "бвгдзклмнпрст" for v in "аеиоу")
GREEK = tuple(c + v for c in "βγδζκλμνπρστ" for v in "αειου")
FOUND = "|".join(f"(?:{p})" for p in KINDS.values())
#: A text without any of these has no entity; each begins with a set of characters, so that it fails fast.
HINTS = (
    r"[0-9@]", r"[=:] ?[\"'][^ \"']{12}", r"name is \p{Lu}", r"[0-9A-Fa-f]:[0-9A-Fa-f:]{2}",
    r"(?=[MSHFDP])(?<!\p{L})(?:M(?:rs?|s|iss|adame?|me|onsieur)|S(?:ir|eñora?|ra?)|Herrn?|Frau|Dr|Doctor|Prof(?:essor)?)\.? \p{Lu}",
)
MARKS = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "sk-")


def may_hold(text: Column) -> Column:
    hint = F.regexp_like(text, F.lit(HINTS[0]))
    for mark in MARKS:
        hint = hint | F.contains(text, F.lit(mark))
    for pattern in HINTS[1:]:
        hint = hint | F.regexp_like(text, F.lit(pattern))
    return F.coalesce(hint, F.lit(False))


def kind_of(entity: Column, context: Column) -> Column:
    """Which kind an entity is; ``context`` is what stands before it."""
    kind = None
    whole = {k: p for k, p in KINDS.items() if not k.startswith("name") and k != "secret"}
    for name, pattern in whole.items():
        test = F.regexp_like(entity, F.lit(f"^(?:{pattern})$"))
        kind = F.when(test, name) if kind is None else kind.when(test, name)
    for name, titles in (("name_m", "Mr|Mr\\.|Sir|Herr|Herrn|Monsieur|Señor|Sr\\."), ("name_f", "Mrs|Mrs\\.|Ms|Ms\\.|Miss|Madam|Frau|Madame|Mme|Señora|Sra\\."), ("name", "Dr|Dr\\.|Prof|Prof\\.|Professor|Doctor|name is")):
        kind = kind.when(F.regexp_like(context, F.lit(f"(?:^|[^\\p{{L}}])(?:{titles}) $")), name)
    return kind.otherwise("secret")


def checksum_holds(digits: Column) -> Column:
    """Whether a number of digits only has the check digit that payment cards have."""
    def add(total: Column, at: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - at, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(at % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _with_check_digit(digits: Column) -> Column:
    """The number with the last digit that makes it a card's; ``digits`` should be a plain column."""
    def add(total: Column, at: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - at, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(at % 2 == 1, doubled).otherwise(digit)

    rest = F.aggregate(F.sequence(F.lit(1), F.length(digits) - 1), F.lit(0), add)
    return F.concat(F.substr(digits, F.lit(1), F.length(digits) - 1), ((10 - rest % 10) % 10).cast("string"))


def canonical(entity: Column, kind: Column) -> Column:
    """The form in which mentions of one entity agree: e-mail in lower case, numbers without grouping."""
    return (F.when(kind == "email", F.lower(entity)).when(kind.isin("card", "phone", "ssn", "iban"), F.regexp_replace(entity, r"[ .\-/()]", ""))
            .otherwise(entity))


def _draws(entity: Column, attempt: Column, key: str, n: int) -> list[Column]:
    """Hex digits of keyed hashes, ``n`` blocks of 64."""
    return [F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(str(i)), attempt.cast("string"), entity), 256) for i in range(n)]


def _number(stream: Column, at: Column, below: int | Column) -> Column:
    """A number below a bound from four hex digits of the stream at the place ``at`` (it repeats beyond its end)."""
    place = F.pmod(at * 4, F.length(stream) - 4) + 1
    return F.pmod(F.conv(F.substr(stream, place, F.lit(4)), 16, 10).cast("int"), F.lit(below) if isinstance(below, int) else below)


def _of(choices: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, choices)), index + 1)


def lettered(text: Column, stream: Column) -> Column:
    """Each digit and letter replaced by one of its class: digit, Latin, Greek or Cyrillic, of the same case."""
    sets = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
            "абвгдежзиклмнопрстуфхцчшщэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ")
    classes = (r"\p{Nd}", r"[\p{IsLatin}&&[^\p{Lu}]]", r"[\p{IsLatin}&&\p{Lu}]", r"[\p{IsGreek}&&\p{L}&&[^\p{Lu}]]", r"[\p{IsGreek}&&\p{Lu}]", r"[\p{IsCyrillic}&&\p{L}&&[^\p{Lu}]]", r"[\p{IsCyrillic}&&\p{Lu}]")

    def one(character: Column, at: Column) -> Column:
        def drawn(members: str) -> Column:
            return F.substr(F.lit(members), _number(stream, at, len(members)) + 1, F.lit(1))

        out = F.when((character >= "0") & (character <= "9"), drawn(sets[0])).when((character >= "a") & (character <= "z"), drawn(sets[1]))
        out = out.when((character >= "A") & (character <= "Z"), drawn(sets[2])).when(character <= "~", character)
        for members, wanted in zip(sets, classes, strict=True):
            out = out.when(F.regexp_like(character, F.lit(wanted)), drawn(members))
        return out.otherwise(character)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _name(text: Column, kind: Column, stream: Column) -> Column:
    """A made name for each word of a name, in its script; the first word ends as its gender's names do."""
    def word(original: Column, at: Column) -> Column:
        second = _number(stream, at * 3 + 1, 8)
        ending = F.when(at > 0, _of(ENDINGS["name"], second)).when(kind == "name_m", _of(ENDINGS["name_m"], second)).when(
            kind == "name_f", _of(ENDINGS["name_f"], second)).otherwise(_of(ENDINGS["name"], second))
        latin = F.concat(_of(SYLLABLES, _number(stream, at * 3, len(SYLLABLES))), _of(SYLLABLES, _number(stream, at * 3 + 2, len(SYLLABLES))), ending)
        cyrillic = F.concat(_of(CYRILLIC, _number(stream, at * 3, len(CYRILLIC))), _of(CYRILLIC, _number(stream, at * 3 + 2, len(CYRILLIC))),
                            F.when(kind == "name_f", "на").otherwise("н"))
        greek = F.concat(_of(GREEK, _number(stream, at * 3, len(GREEK))), _of(GREEK, _number(stream, at * 3 + 2, len(GREEK))), F.when(kind == "name_f", "α").otherwise("ος"))
        return F.initcap(F.when(F.regexp_like(original, F.lit(r"\p{IsCyrillic}")), cyrillic).when(F.regexp_like(original, F.lit(r"\p{IsGreek}")), greek).otherwise(latin))

    return F.array_join(F.transform(F.split(text, " "), word), " ")


def stream_of(entity: Column, kind: Column, attempt: Column, key: str) -> Column:
    """256 hex digits that choose the surrogate of an entity at an attempt."""
    return F.concat(*_draws(F.concat_ws("\x1e", kind, entity), attempt, key, 4))


def surrogate(entity: Column, kind: Column, stream: Column, drawn: Column) -> Column:
    """The surrogate of a canonical entity, from its stream and its letters and digits as drawn (``lettered``)."""
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: _number(stream, i, F.when(i == 0, 223).otherwise(256)) + F.when(i == 0, 1).otherwise(0)), ".")
    email = F.concat(F.regexp_replace(drawn, r"\.[^.]*$", ""), F.regexp_extract(entity, r"(\.[^.]+)$", 1))
    prefix = F.regexp_extract(entity, r"^(AKIA|ASIA|gh[pos]_|sk-)", 1)
    length = F.length(entity)
    tiled = F.substr(F.repeat(stream, F.ceil(length / F.length(stream)).cast("int") + 1), F.lit(1), length)
    secret = F.when(F.regexp_like(entity, F.lit(r"^[0-9a-f]+$")), tiled).otherwise(F.concat(prefix, F.substr(drawn, F.length(prefix) + 1)))
    hexed = F.array_join(F.transform(F.split(entity, ""), lambda c, i: F.when(c == ":", c).otherwise(F.substr(stream, F.pmod(i, F.length(stream)) + 1, F.lit(1)))), "")
    phone = F.when(entity.startswith("+1"), F.concat(F.lit("+1"), F.substr(drawn, F.lit(3)))).otherwise(drawn)
    return (F.when(kind == "ip", octets).when(kind == "ipv6", hexed).when(kind == "email", email).when(kind == "secret", secret).when(kind == "phone", phone)
            .when(kind == "iban", F.concat(F.left(entity, F.lit(2)), F.substr(drawn, F.lit(3)))).when(kind == "card", _with_check_digit(drawn))
            .when(kind.startswith("name"), _name(entity, kind, stream)).otherwise(drawn))


def regrouped(mention: Column, entity: Column, replacement: Column, kind: Column) -> Column:
    """The surrogate in the mention's own form: its grouping of digits, its case of an e-mail address."""
    def one(character: Column, at: Column) -> Column:
        taken = F.length(F.regexp_replace(F.substr(mention, F.lit(1), at), r"[ .\-/()]", ""))
        return F.when(F.regexp_like(character, F.lit(r"[ .\-/()]")), character).otherwise(F.substr(replacement, taken + 1, F.lit(1)))

    grouped = F.concat(F.array_join(F.transform(F.split(mention, ""), one), ""), F.substr(replacement, F.length(entity) + 1))  # what a crowded form adds
    return (F.when(kind.isin("card", "phone", "ssn", "iban") & (mention != entity), grouped)
            .when((kind == "email") & (mention == F.upper(mention)) & (mention != F.lower(mention)), F.upper(replacement)).otherwise(replacement))


def longer(one: Column, kind: Column, stream: Column, attempt: int) -> Column:
    """A surrogate with so many further characters as its form has been too crowded for."""
    more = attempt - LONGER + 1
    if more < 1:
        return one
    hexes = F.substr(F.repeat(stream, 1 + more // 256), F.lit(1), F.lit(more))
    letters, digits = F.translate(hexes, "0123456789", "ghijklmnop"), F.translate(hexes, "abcdef", "012345")
    return F.when(kind == "email", F.concat(letters, one)).when(kind.startswith("name") | (kind == "secret"), F.concat(one, letters)).otherwise(
        F.concat(one, digits))


def assigned(entities: DataFrame, key: str) -> DataFrame:
    """``entity``, ``sort``, ``surrogate`` of each distinct (entity, sort), all surrogates distinct and none an entity.

    A name met after forms of address of one gender has that gender.

    Each round draws for those without one; of equal draws the one with the smallest hash stays,
    unless an earlier round gave it away or it is itself an entity of the data. From some round
    on the forms grow, so a round leaves a small part of the one before.
    """
    genders = entities.groupBy("entity", "sort").agg(F.min("kind").alias("low"), F.max("kind").alias("high"), F.min(F.when(F.col("kind") != "name", F.col("kind"))).alias("least"))
    agreed = F.when(F.col("sort") != "name", F.col("low")).when(F.col("least").isNull() | (F.col("least") == F.col("high")), F.col("high")).when(
        F.col("low") == "name", F.when(F.col("least") == F.col("high"), F.col("least")).otherwise("name")).otherwise("name")
    known = stored(genders.select("entity", "sort", agreed.alias("kind")), "entities")
    open_, done = known, None
    taken_forms = known.select(F.col("entity").alias("drawn"))
    attempt = 0
    while True:
        streamed = open_.withColumn("stream", stream_of(F.col("entity"), F.col("sort"), F.lit(attempt), key))
        streamed = streamed.withColumn("letters", lettered(F.col("entity"), F.col("stream")))
        made = surrogate(F.col("entity"), F.col("kind"), F.col("stream"), F.col("letters"))
        drawn = stored(streamed.select("entity", "sort", longer(made, F.col("kind"), F.col("stream"), attempt).alias("drawn")), "drawn")
        order = F.struct(F.xxhash64("entity", "sort").alias("x"), "entity", "sort")
        first = drawn.groupBy("drawn").agg(F.min(order).alias("first"))
        free = first.join(taken_forms, "drawn", "left_anti")
        if done is not None:
            free = free.join(done.select(F.col("surrogate").alias("drawn")), "drawn", "left_anti")
        given = stored(free.select(F.col("first.entity").alias("entity"), F.col("first.sort").alias("sort"), F.col("drawn").alias("surrogate")), "surrogates")
        done = given if done is None else done.unionByName(given)
        open_ = open_.join(given.select("entity", "sort"), ["entity", "sort"], "left_anti")
        attempt += 1
        if attempt % 8 == 0:
            open_, done = stored(open_, "open"), stored(done, "surrogates")
        if open_.isEmpty():
            return done


def replace(df: DataFrame, key: str, text: str = "text", counts: bool = True) -> DataFrame:
    """The frame with its entities replaced in ``text``, and ``n_entities`` if ``counts``.

    Whoever has the ``key`` can tell which surrogate an entity has, so it is to be kept secret.

    Texts with entities are cut at them once; only the entities are shuffled and given
    surrogates, and come back to their text by a row number's place in a stored table.
    """
    names = df.columns
    found, pieces, row = (fresh(df, x) for x in ("found", "pieces", "row"))
    body = F.col(f"`{text}`").cast("string")
    plain = df.where(~may_hold(body)).select(*(F.col(f"`{c}`") for c in names), *([F.lit(0).alias("n_entities")] if counts else []))
    cut = stored(
        df.where(may_hold(body)).withColumns({
            found: F.regexp_extract_all(body, F.lit(f"({FOUND})"), F.lit(0)), pieces: F.split(body, FOUND), row: F.monotonically_increasing_id()}),
        "cut")
    both = F.transform(F.col(found), lambda m, i: F.struct(m.alias("mention"), F.right(F.get(F.col(pieces), i), F.lit(12)).alias("before")))
    each = cut.select(row, F.posexplode(both).alias("at", "both")).select(row, "at", "both.mention", "both.before")
    kinds = each.select(row, "at", "mention", kind_of(F.col("mention"), F.col("before")).alias("kind"))
    typed = stored(kinds.select(
        row, "at", "mention", "kind", F.when(F.col("kind").startswith("name"), "name").otherwise(F.col("kind")).alias("sort"),
        canonical(F.col("mention"), F.col("kind")).alias("entity")), "mentions")
    real = typed.where((F.col("kind") != "card") | checksum_holds(F.col("entity")))
    given = assigned(real, key)
    replaced = regrouped(F.col("mention"), F.col("entity"), F.col("surrogate"), F.col("kind"))
    new = typed.join(given, ["entity", "sort"], "left").select(
        row, "at", F.coalesce(replaced, "mention").alias("new"), F.col("surrogate").isNotNull().cast("int").alias("changed"),
        F.when(F.col("sort") == "name", F.struct((-F.length("mention")).alias("less"), "mention", F.col("surrogate").alias("by"))).alias("called"))
    lists = new.groupBy(row).agg(
        F.array_sort(F.collect_list(F.struct("at", "new"))).alias("_new"), F.sum("changed").cast("int").alias("_changed"),
        F.array_sort(F.collect_set("called")).alias("_called"))
    joined = cut.join(lists, row, "left")
    after = F.transform("_new", lambda x: x["new"])
    woven = F.array_join(F.flatten(F.zip_with(F.col(pieces), after, lambda a, b: F.array(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))), "")
    # names of several words, also where the document repeats them without a form of address; longer ones first
    called = F.filter("_called", lambda c: c["mention"].contains(" ") & c["by"].isNotNull())

    def whole_name(c: Column) -> Column:
        return F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), c["mention"], F.lit(r"\E(?![\p{L}\p{N}])"))

    places = F.struct(woven.alias("text"), F.lit(0).alias("n"))
    again = F.aggregate(called, places, lambda acc, c: F.struct(
        F.regexp_replace(acc["text"], whole_name(c), c["by"]).alias("text"),
        (acc["n"] + F.size(F.regexp_extract_all(acc["text"], whole_name(c), F.lit(0)))).alias("n")))
    ended = joined.withColumn("_ended", F.when((F.col("_changed") > 0) & (F.size(called) > 0), again).when(F.col("_changed") > 0, places))
    whole = F.coalesce(F.col("_ended.text"), body).alias(text)
    n = (F.coalesce("_changed", F.lit(0)) + F.coalesce("_ended.n", F.lit(0))).cast("int").alias("n_entities")
    changed = ended.select(*(whole if c == text else F.col(f"`{c}`") for c in names), *([n] if counts else []))
    return plain.unionByName(changed)
