"""Surrogates for personal data and secrets (DataFrame operations only).

Entities are found by one pattern. Each distinct entity (type and canonical
form, so that spellings of one e-mail address or number agree) gets a
surrogate made from a keyed hash of it:

* numbers keep their punctuation, addresses their parts, keys their prefix,
  every other digit, lower-case and upper-case letter becomes one of its kind;
* a card number passes the check-digit rule, as the original does (numbers that
  don't pass it are not taken for cards);
* keywords before secrets and titles before names count in any case (but "miss" and "ms"), and an occurrence in capitals gets
  its surrogate in capitals; a hexadecimal secret is the same in small letters and in capitals;
* a name after a title gets a given name of the title's gender and a family
  name in the same script (Latin or Cyrillic); the title stays.

The same entity has the same surrogate in all texts (coreference), and two
entities of a type never share one (distinctness): candidates are grouped by
value, the first claimant keeps it and the others, and those equal to an
entity that occurs in the texts, draw again until nobody has to. From the
``WIDEN``-th draw on a candidate grows by a character, so this ends
even where a format has fewer values than there are entities.

Texts are cut at their entities and put together again with the surrogates
between the parts. Only texts with entities are joined; the table of distinct
entities is pre-aggregated, so an entity in a third of all texts is one row.

Defined results: null texts stay null; texts without entities are
returned unchanged; rows with null or repeated ids and further columns pass through.
The key is a parameter: another key gives other surrogates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, staged

KEY = "a key that the caller replaces"
WIDEN = 24

# Titles and the names that surrogates are taken from.
MALE = {"latin": "Mr|Herr|Señor|Monsieur|Sr", "cyrillic": "Господин|Г-н"}
FEMALE = {"latin": "Mrs|Ms|Miss|Frau|Señora|Señorita|Madame|Mme|Mlle|Sra", "cyrillic": "Госпожа|Г-жа"}
EITHER = "Dr|Prof|Доктор"
GIVEN = {
    ("latin", "m"): "Adrian Bruno Cedric Daniel Emil Felix Gabriel Hugo Ivan Julian Konrad Leon Martin Nils Oscar Paul Quentin Robin Simon Thomas",
    ("latin", "f"): "Alma Beatrice Clara Diana Elena Flora Greta Helena Irene Julia Klara Laura Maria Nora Olivia Paula Rosa Sofia Tessa Vera",
    ("latin", "e"): "Alex Billie Charlie Dominique Eden Frankie Jules Kim Lou Maxime Nicky Robin Sacha Sam Toni",
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим Никита Олег Павел Роман Сергей",
    ("cyrillic", "f"): "Алла Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина Ольга Полина Раиса",
    ("cyrillic", "e"): "Саша Женя Валя Слава",
}
ONSETS = {"latin": "b br d dr f g gr h k kl l m n p pr r s st t tr v w".split(), "cyrillic": "б бр в г гр д др ж з к кл л м н п пр р с ст т".split()}
VOWELS = {"latin": "a e i o u".split(), "cyrillic": "а е и о у".split()}

TITLES = r"(?!miss\b|ms\b)(?iu:" + "|".join([*MALE.values(), *FEMALE.values(), EITHER]) + ")"  # in small letters, a verb and milliseconds
WORDS_BEFORE = "password|passwd|pwd|secret|token|api_key|apikey"
ASSIGNED = rf"""(?i:{WORDS_BEFORE}) {{0,3}}[=:] {{0,3}}["']?"""
PATTERNS = {
    "email": r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}",
    "key": r"(?:AKIA|ASIA)[A-Z0-9]{16}\b|gh[pousr]_[A-Za-z0-9]{36,}\b|sk-[A-Za-z0-9]{20,}\b",
    "secret": rf"""{ASSIGNED}[A-Za-z0-9+/_.-]{{7,}}[A-Za-z0-9+/_-]""",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "card": r"(?<![\w.-])[2-6]\d{3}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?![\w-])",
    "social": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+.])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])",
    "name": rf"{TITLES}\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+)?",
}
# Entities start where no letter or digit stands before them.
PATTERN = r"(?<![\p{L}\p{N}_])(?:" + "|".join(PATTERNS.values()) + ")"
# What tells a found entity's type, first match first.
KINDS = [("secret", "^" + ASSIGNED), ("email", "@"), ("key", r"^(?:AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_|^sk-"), ("ip", r"^\d{1,3}(?:\.\d{1,3}){3}$"),
         ("name", rf"^{TITLES}\.? \p{{Lu}}"), ("social", r"^\d{3}-\d{2}-\d{4}$"), ("card", r"^[2-6](?:[ -]?\d){12,18}$"),
         ("iban", r"^[A-Z]{2}\d{2}[A-Z0-9 ]+$"), ("phone", r"^[+(\d][\d ().-]+$")]


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _kind(found: str) -> str:
    return "CASE " + " ".join(f"WHEN {found} RLIKE {_lit(p)} THEN '{k}'" for k, p in KINDS) + " ELSE 'secret' END"


def _canonical(kind: str, found: str) -> str:
    title = _lit(rf"^{TITLES}\.? ")
    return (f"CASE {kind} WHEN 'email' THEN lower({found}) WHEN 'card' THEN regexp_replace({found}, '[ -]', '') "
            f"WHEN 'phone' THEN regexp_replace({found}, '[^0-9+]', '') WHEN 'social' THEN replace({found}, '-', '') "
            f"WHEN 'iban' THEN replace({found}, ' ', '') WHEN 'name' THEN lower(regexp_replace({found}, {title}, '')) "
            f"WHEN 'secret' THEN {_caseless(_secret(found))} ELSE {found} END")


def _secret(found: str) -> str:
    return f"regexp_replace({found}, {_lit('^' + ASSIGNED)}, '')"


def _caseless(secret: str) -> str:
    """Hexadecimal text of one case in lower case, other secrets as they are."""
    return f"if({secret} RLIKE '^[0-9A-F]+$', lower({secret}), {secret})"


def _traits(found: str) -> str:
    """For names, script and gender; else empty. Part of an entity's identity."""
    script = f"if({found} RLIKE '[\\\\p{{IsCyrillic}}]', 'cyrillic', 'latin')"
    any_of = lambda titles: _lit("^(?iu:" + "|".join(titles.values()) + r")\.? ")
    return f"concat({script}, '/', CASE WHEN {found} RLIKE {any_of(MALE)} THEN 'm' WHEN {found} RLIKE {any_of(FEMALE)} THEN 'f' ELSE 'e' END)"


def _value(i: str) -> str:
    """The ``i``-th number (from 1) of the hash stream, 0 to 65535."""
    return f"cast(conv(substr(stream, 4 * ({i}) - 3, 4), 16, 10) AS int)"


def _mask(source: str) -> str:
    """Every digit and letter of ``source`` becomes another of its kind; hexadecimal text stays so."""
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    letters = f"if({source} RLIKE '^[0-9a-f]+$', 6, 26)"
    return (f"array_join(transform(sequence(1, char_length({source})), i -> CASE "
            f"WHEN substr({source}, i, 1) RLIKE '[0-9]' THEN cast({_value('i')} % 10 AS string) "
            f"WHEN substr({source}, i, 1) RLIKE '[a-z]' THEN substr('{lower}', {_value('i')} % {letters} + 1, 1) "
            f"WHEN substr({source}, i, 1) RLIKE '[A-Z]' THEN substr('{upper}', {_value('i')} % 26 + 1, 1) "
            f"ELSE substr({source}, i, 1) END), '')")


def _luhn(digits: str) -> str:
    """The check sum modulo 10 of a digit string."""
    at = f"cast(substr({digits}, char_length({digits}) - i, 1) AS int)"
    return (f"aggregate(transform(sequence(0, char_length({digits}) - 1), i -> if(i % 2 = 0, {at}, {at} * 2 - if({at} > 4, 9, 0))), 0, (s, x) -> s + x) % 10")


def _names() -> str:
    cases = []
    for (script, gender), names in GIVEN.items():
        pick = lambda items, i: f"element_at(array({', '.join(_lit(x) for x in items)}), {_value(i)} % {len(items)} + 1)"
        family = ", ".join(pick(ONSETS[script], str(2 * k + 2)) + ", " + pick(VOWELS[script], str(2 * k + 3)) for k in range(3))
        tail = f", {pick(ONSETS[script][:4], '9')}"
        cases.append(f"WHEN '{script}/{gender}' THEN concat({pick(names.split(), '1')}, ' ', initcap(concat({family}{tail}, wide)))")
    return "CASE traits " + " ".join(cases) + " END"


def candidates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``entities`` (kind, canon, traits, draw) with the surrogate of that draw, in canonical form."""
    source = "concat(canon, wide)"
    stream = (f"array_join(transform(sequence(0, cast((char_length(canon) + draw) / 16 AS int) + 2), "
              f"b -> sha2(concat_ws('|', {_lit(key)}, kind, traits, canon, draw, b), 256)), '')")
    octets = ", ".join(f"{_value(str(k))} % 254 + 1" for k in range(1, 5))
    card = "concat(substr(canon, 1, 1), substr(masked, 2, char_length(masked) - 2))"  # all but the check digit
    passes = _luhn("concat(body, '0')")
    digit = f"(10 - {passes}) % 10"
    whole = f"concat(body, {digit})"
    return (entities
            .withColumn("wide", F.expr(f"repeat('0', cast(draw / {WIDEN} AS int))"))
            .withColumn("stream", F.expr(stream))
            .withColumn("masked", F.expr(f"CASE WHEN kind = 'email' THEN {_mask(_local())} ELSE {_mask(source)} END"))
            .withColumn("body", F.expr(card))
            .withColumn("surrogate", F.expr(
                f"CASE kind WHEN 'email' THEN concat(masked, '@mail', {_value('40')} % 100, '.example.org') "
                f"WHEN 'ip' THEN concat(concat_ws('.', {octets}), if(wide = '', '', concat('.', masked))) "
                f"WHEN 'card' THEN {whole} "
                f"WHEN 'phone' THEN if(canon LIKE '+%', concat(substr(canon, 1, 2), substr(masked, 3)), masked) "
                f"WHEN 'iban' THEN concat(substr(canon, 1, 2), substr(masked, 3)) "
                f"WHEN 'key' THEN concat(substr(canon, 1, 4), substr(masked, 5)) "
                f"WHEN 'name' THEN {_names()} ELSE masked END"))
            .drop("wide", "stream", "masked", "body"))


def _local() -> str:
    return "concat(substring_index(canon, '@', 1), wide)"


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``(kind, canon, traits, surrogate)``: distinct surrogates for the distinct entities."""
    open_rows = entities.select("kind", "canon", "traits").distinct().withColumn("draw", F.lit(0))
    real = staged(open_rows, "pii-entities")
    taken = staged(candidates(real, key), "pii-draw0")
    number = 0
    while True:
        # Who claims a value first (fewest draws, then smallest) keeps it, unless the texts have it as an entity.
        value = (F.when(F.col("kind") == "name", F.lower("surrogate")).when(F.col("kind") == "secret", F.expr(_caseless("surrogate")))
                 .otherwise(F.col("surrogate")))
        claims = taken.withColumn("value", value)
        first = claims.groupBy("kind", "value").agg(F.min(F.struct("draw", "canon", "traits")).alias("first"))
        first = first.join(real.select("kind", F.col("canon").alias("value"), F.lit(True).alias("occurs")).distinct(), ["kind", "value"], "left")
        judged = claims.join(first, ["kind", "value"]).withColumn(
            "lost", F.col("occurs").isNotNull() | (F.col("first.canon") != F.col("canon")) | (F.col("first.traits") != F.col("traits")))
        again = judged.filter("lost")
        if again.isEmpty():
            return taken.drop("draw")
        number += 1
        redrawn = candidates(again.select("kind", "canon", "traits", (F.col("draw") + 1).alias("draw")), key)
        taken = staged(judged.filter("not lost").select(*taken.columns).unionByName(redrawn.select(*taken.columns)), f"pii-draw{number}")


def _formatted(kind: str, found: str, surrogate: str) -> str:
    """The surrogate in the spelling of one occurrence."""
    digits = (f"aggregate(split({found}, ''), struct('' AS out, 1 AS i), (s, c) -> if(c RLIKE '[0-9A-Z]', "
              f"struct(concat(s.out, substr(plain, s.i, 1)) AS out, s.i + 1 AS i), struct(concat(s.out, c) AS out, s.i AS i)), "
              f"s -> concat(s.out, substr(plain, s.i)))").replace("plain", f"replace({surrogate}, '+', '')")
    upper = lambda part: f"if({part} = upper({part}), upper({surrogate}), {surrogate})"
    alone = _lit(rf"^{TITLES}\.? ")
    title = _lit(rf"^({TITLES}\.? ).*$")
    return (f"CASE WHEN {kind} IN ('phone', 'card', 'social', 'iban') THEN {digits} "
            f"WHEN {kind} = 'name' THEN concat(regexp_extract({found}, {title}, 1), {upper(f"regexp_replace({found}, {alone}, '')")}) "
            f"WHEN {kind} = 'secret' THEN concat(regexp_extract({found}, {_lit('^(' + ASSIGNED + ')')}, 1), {upper(_secret(found))}) "
            f"WHEN {kind} = 'email' AND {found} = upper({found}) THEN upper({surrogate}) ELSE {surrogate} END")


def pseudonymise(docs: DataFrame, text: str = "text", key: str = KEY) -> tuple[DataFrame, dict]:
    """``docs`` with surrogates in ``text``; adds the number and the types of the entities replaced.

    Returns the frame and the names of the added columns: ``n_entities``, ``kinds``.
    """
    names = dict(zip(("row", "found", "n_entities", "kinds", "new", "key"), fresh(docs, "row", "found", "n_entities", "kinds", "new", "key"), strict=True))
    row, found = names["row"], names["found"]
    kept = staged(docs.withColumn(row, F.monotonically_increasing_id()).withColumn(
        found, F.regexp_extract_all(F.col(text), F.lit(f"({PATTERN})".replace(r"\1", r"\2")), F.lit(1))), "pii-docs")
    has = F.size(F.coalesce(found, F.array())) > 0
    spots = (kept.filter(has).select(F.col(row).alias("row"), F.posexplode(found).alias("at", "found"))
             .withColumn("kind", F.expr(_kind("found"))).withColumn("canon", F.expr(_canonical("kind", "found")))
             .withColumn("traits", F.expr(f"if(kind = 'name', {_traits('found')}, '')")))
    # a number of a card's length is one only if it passes the check-digit rule; others stay as they are
    spots = staged(spots.withColumn("kind", F.expr(f"if(kind = 'card' AND {_luhn('canon')} != 0, null, kind)")), "pii-spots")
    chosen = assign(spots.filter("kind is not null"), key)
    replaced = (spots.join(chosen, ["kind", "canon", "traits"], "left")
                .select("row", F.struct("at", F.coalesce(F.expr(_formatted("kind", "found", "surrogate")), "found").alias("new"), "kind").alias("x"))
                .groupBy("row").agg(F.sort_array(F.collect_list("x")).alias("xs"))  # what one text has
                .select(F.col("row").alias(names["key"]), F.col("xs.new").alias(names["new"]),
                        F.array_compact(F.col("xs.kind")).alias(names["kinds"])))
    parts = f"split(`{text}`, {_lit(PATTERN)}, -1)"
    joined = (kept.filter(has).join(replaced, F.col(row) == F.col(names["key"]))
              .withColumn(text, F.expr(f"array_join(transform({parts}, (p, i) -> concat(p, coalesce(get(`{names['new']}`, i), ''))), '')")))
    columns = [*docs.columns]
    changed = joined.select(*columns, F.size(names["kinds"]).cast("bigint").alias(names["n_entities"]), names["kinds"])
    same = kept.filter(~has).select(*columns, F.lit(0).cast("bigint").alias(names["n_entities"]), F.array().cast("array<string>").alias(names["kinds"]))
    return same.unionByName(changed), {k: names[k] for k in ("n_entities", "kinds")}
