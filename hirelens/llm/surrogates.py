"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Every distinct entity of the corpus gets one surrogate, so that mentions that meant the same still do (coreference)
and different entities stay different: candidates are drawn from a keyed hash and checked against each other and
against all real entities; whoever loses draws again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import match_spans, replace_spans, store

# What is looked for.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+"
IP = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)"
# Phones: international; area code in brackets; 3-3-4; a leading 0 with 9 to 12 digits; any after a word for a phone.
_SAID = r"(?<=(?:[Tt]el|TEL|[Tt]elefono|[Tt]eléfono|[Tt]elefon|[Tt]éléphone|[Tt]él|[Pp]hone|PHONE|[Ff]on|[Ff]ax|FAX|[Mm]obile|[Mm]obil|[Mm]óvil|[Hh]andy|[Cc]ell|[Тт]ел)[.:]{0,2}\x20{0,2})"
PHONE = (r"(?:(?<!\w)\+\d{1,3}[ -]?\(?\d{2,4}\)?(?:[ -]?\d{2,4}){2,4}(?!\d)"
         r"|(?<![\w.+)-])\(0?\d{2,4}\)[ -]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\d)"
         r"|(?<![\w.+/:-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d/]|[ .-]\d)"
         r"|(?<![\w.,+/:-])0(?=(?:[ /-]?\d){8,11}(?!\d|[ /-]\d))\d{1,4}[ /-]\d{2,8}(?:[ /-]\d{2,8}){0,4}(?![\w/:]|[ .-]\d)"
         rf"|(?=[(\d])(?<!\w){_SAID}\(?\d(?:[ ./()-]{{0,2}}\d){{6,14}}(?!\d))")
# Cards: 13 to 19 digits in one, or grouped 4-4-4-4(-3), 4-6-5, 4-6-4, 4-4-5, 6-13.
CARD_FORM = r"(?:\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{3})?|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{4}[ -]\d{4}[ -]\d{5}|\d{6}[ -]\d{13}|\d{13,19})"
CARD = rf"(?<![\d.]){CARD_FORM}(?![\d.]*\d)"
FEMALE = r"(?:Mrs|Ms|Miss|Frau|Fräulein|Mme|Mlle|Madame|Mademoiselle|Lady|Señora|Señorita|Srta|Sra|Doña|Dra|Г-жа|Госпожа)"
MALE = r"(?:Mr|Mister|Herr|Monsieur|Sir|Señor|Sr|Don|Г-н|Господин)"
BOTH = r"(?:Dr|Doctor|Doktor|Docteur|Prof|Professor|Professeur|Mx|Доктор|(?:[Mm]y|[Ff]ull|[Cc]ontact) name(?: is|:)|Name:|[Ii]ch heiße|[Jj]e m'appelle|[Mm]e llamo)"
TITLE = rf"(?:{FEMALE}|{MALE}|{BOTH}|M(?=\.))"
NAME = rf"(?<!\p{{L}}){TITLE}\.? (?:{TITLE}\.? )*\p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?"
ANY = "|".join((EMAIL, IP, CARD, PHONE, NAME))
PART = "struct<start:int,end:int,kind:string,norm:string,value:string>"


TITLES = ("Mr", "Ms", "Miss", "Mister", "Frau", "Fräulein", "Mme", "Mlle", "Madame", "Mademoiselle", "Lady", "Señor", "Srta",
          "Sra", "Sr", "Doña", "Don", "Dr", "Г-", "Господин", "Госпожа", "Herr", "Monsieur", "Sir", "M.", "Doctor", "Doktor",
          "Docteur", "Prof", "Mx", "Доктор", "name", "Name", "heiße", "appelle", "llamo")


def may_mention(text: Column) -> Column:
    """A cheap test that every text with a mention passes: a digit, an @ or a title."""
    out = text.rlike("[0-9@]")
    for title in TITLES:
        out = out | text.contains(title)
    return F.coalesce(out, F.lit(False))


def mentions(text: Column) -> Column:
    """Mentions in order: start, end, kind, norm (what mentions of one entity share) and value.

    A name gives a part for the given name, if there is one, and one for the surname; the title stays.
    """
    digits = lambda v: F.regexp_replace(v, "[^0-9]", "")

    def parts(x: Column) -> Column:
        v, start, end = x["value"], x["start"], x["end"]
        part = lambda s, e, kind, norm, value: F.struct(
            s.alias("start"), e.alias("end"), kind.alias("kind"), norm.alias("norm"), value.alias("value"))
        named = F.regexp_replace(v, rf"^(?:{TITLE}\.? )+", "")
        words = F.split(named, " ")
        last = F.element_at(words, F.lit(-1))
        title = F.substring(v, F.lit(1), F.length(v) - F.length(named))
        given = (F.when(title.rlike(rf"(?<!\p{{L}}){FEMALE}(?!\p{{L}})"), F.lit("given_f"))
                 .when(title.rlike(rf"(?<!\p{{L}})(?:{MALE}|M(?=\.))(?!\p{{L}})"), F.lit("given_m")).otherwise(F.lit("given")))
        surname = part(end - F.length(last), end, F.lit("surname"), F.lower(last), last)
        first = words[0]
        from_ = end - F.length(named)
        whole = lambda kind, norm: F.array(part(start, end, F.lit(kind), norm, v))
        return (F.when(v.contains("@"), whole("email", F.lower(v)))
                .when(v.rlike(rf"^{IP}$"), whole("ip", v))
                .when(v.rlike(rf"^{CARD_FORM}$"), whole("card", digits(v)))
                .when(v.rlike("^[+(0-9]"), whole("phone", digits(v)))
                .when(F.size(words) > 1, F.array(part(from_, from_ + F.length(first), given, F.lower(first), first), surname))
                .otherwise(F.array(surname)))

    return F.flatten(F.transform(match_spans(text, ANY), parts))


def _draw(key: str, attempt: int, kind: Column, norm: Column) -> Column:
    """64 keyed hash bytes per entity and attempt, as hexadecimal digits."""
    seed = F.concat_ws("\u0001", F.lit(key), F.lit(str(attempt)), kind, norm)
    return F.concat(F.sha2(seed, 512))


def _byte(draw: Column, i: Column) -> Column:
    return F.conv(F.substring(draw, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _mapped(draw: Column, text: Column) -> Column:
    """Each letter by one of its script and sort (vowel or consonant), each digit by a digit; the rest stays."""
    # letters that no later set names go by their script
    sets = [(r"\p{IsLatin}", "bcdfghklmnprstvz"), (r"\p{IsCyrillic}", "бвгдзклмнпрст"), (r"\p{IsGreek}", "βγδζθκλμνξπρστ"),
            (r"\p{IsArmenian}", "բգդզթժլխծկհղճմնշչպջռսվտրցփք"), (r"\p{IsGeorgian}", "ბგდვზთკლმნპჟრსტფქღყშჩცძწჭხჯჰ"),
            (r"(?:(?!\p{IsLatin}|\p{IsCyrillic}|\p{IsGreek}|\p{IsArmenian}|\p{IsGeorgian})\p{L})", "bcdfghklmnprstvz"),
            ("աեէըիոօ", "աեէըիոօ"), ("აეიოუ", "აეიოუ"), ("іїєў", "аеиоу"),
            ("ăắằẳẵặấầẩẫậạảãẹẻẽếềểễệịỉĩọỏõốồổỗộơớờởỡợụủũưứừửữựýỳỷỹỵāēīōūąęįųėıåæøœő\u0171", "aeiou"),
            ("aeiouäöüáéíóúàèìòùâêîôûëï", "aeiou"), ("bcdfghjklmnpqrstvwxyzñçß", "bcdfghklmnprstvz"),
            ("аеиоуыэюяё", "аеиоу"), ("бвгджзйклмнпрстфхцчшщъь", "бвгдзклмнпрст"),
            ("αεηιουωάέήίόύώ", "αεηιουω"), ("βγδζθκλμνξπρσςτφχψ", "βγδζθκλμνξπρστ"), ("0123456789", "0123456789")]

    def one(c: Column, i: Column) -> Column:
        out = c
        for old, new in sets:
            # (an empty string would be in every set)
            met = c.rlike(old) if old.startswith(("\\p", "(?:")) else F.lit(old).contains(c) & (c != "")
            out = F.when(met, F.substring(F.lit(new), _byte(draw, i) % len(new) + 1, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), one), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits, the last one being the check digit."""
    n = F.length(digits)
    return F.aggregate(F.transform(F.split(digits, ""), lambda c, i: F.when(
        (n - i) % 2 == 1, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int"))),
        F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0)))


def surrogate(key: str, attempt: int, kind: Column, norm: Column) -> Column:
    draw = _draw(key, attempt, kind, norm)
    byte = lambda i: _byte(draw, F.lit(i))
    mapped = _mapped(draw, norm)
    digits = F.concat((byte(63) % 9 + 1).cast("string"), F.substring(mapped, F.lit(2), F.length(norm)))
    body = F.substring(digits, F.lit(1), F.length(norm) - 1)
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    card = F.when(luhn_sum(norm) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(digits)
    at = F.length(norm) - F.length(F.substring_index(norm, ".", -1))
    email = F.concat(F.substring(mapped, F.lit(1), at), F.substring_index(norm, ".", -1))
    cyrillic = norm.rlike(r"\p{IsCyrillic}")
    stem = F.substring(mapped, F.lit(1), F.greatest(F.length(norm) - 1, F.lit(2)))
    return (F.when(kind == "ip", F.concat_ws(".", *[(byte(i) % 254 + 1).cast("string") for i in (1, 2, 3, 4)]))
            .when(kind == "card", card).when(kind == "phone", digits).when(kind == "email", email)
            .when(kind == "given_f", F.concat(stem, F.when(cyrillic, "а").otherwise("a")))
            .when(kind == "given_m", F.concat(stem, F.when(cyrillic, "н").otherwise("n")))
            .otherwise(mapped))


def assign(entities: DataFrame, key: str, rounds: int = 40) -> DataFrame:
    """A surrogate for every entity (kind, norm), no two alike in a kind and none that is a real entity's norm.

    Each round stores its winners (the least norm of those that drew the same) and the rest draws again, so later
    rounds are small. Who is left after all rounds, or after one without a winner, gets a numbered surrogate: numbers
    differ, so those that remain only meet surrogates given before and real entities, and then go on with a longer
    number. Numbers longer than every norm meet none, so this ends.
    """
    real = entities.select("kind", F.col("norm").alias("surrogate"))
    won, rest = None, entities
    for attempt in range(rounds):
        drawn = rest.withColumn("surrogate", surrogate(key, attempt, F.col("kind"), F.col("norm")))
        free = drawn.join(real, ["kind", "surrogate"], "left_anti")
        if won is not None:
            free = free.join(won.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        place = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("norm"))
        winners = store(free.withColumn("place", place).where("place = 1").select("kind", "norm", "surrogate"), "won")
        won = winners if won is None else won.union(winners)
        rest = store(rest.join(winners.select("kind", "norm"), ["kind", "norm"], "left_anti"), "rest")
        if rest.isEmpty():
            return won
        if winners.isEmpty():
            break
    digits = 2
    while not rest.isEmpty():
        ranked = numbered(rest, key)
        digits = max(digits, len(f"{ranked.agg(F.max('number')).first()[0]:x}"))
        drawn = ranked.withColumn("surrogate", extended(key, rounds, F.col("kind"), F.col("norm"), F.col("number"), digits))
        free = drawn.join(real, ["kind", "surrogate"], "left_anti")
        if won is not None:
            free = free.join(won.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        winners = store(free.select("kind", "norm", "surrogate"), "won")
        won = winners if won is None else won.union(winners)
        rest = store(rest.join(winners.select("kind", "norm"), ["kind", "norm"], "left_anti"), "rest")
        digits += 1
    return won


def numbered(entities: DataFrame, key: str, parts: int = 256) -> DataFrame:
    """``entities`` with number: distinct and from 0 on, in an order that the key decides, with no task for all."""
    order = F.sha2(F.concat_ws("\u0001", F.lit(key), "kind", "norm"), 256)
    rows = entities.withColumn("__order", order).withColumn("__part", F.pmod(F.xxhash64("__order"), F.lit(parts)))
    sizes = rows.groupBy("__part").count()  # a fixed number of rows at most
    before = F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.join(F.broadcast(sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))), "__part")
    place = F.row_number().over(Window.partitionBy("__part").orderBy("__order", "kind", "norm"))
    return store(rows.select("kind", "norm", (F.col("__before") + place - 1).alias("number")), "numbered")


def extended(key: str, attempt: int, kind: Column, norm: Column, number: Column, digits: int) -> Column:
    """A drawn surrogate made longer by ``number`` in ``digits`` places, so that different numbers never meet.

    Numbers are written with letters of the name's script, or with decimal digits, three to a place.
    """
    drawn = surrogate(key, attempt, kind, norm)
    places = F.lpad(F.lower(F.hex(number)), digits, "0")
    code = F.translate(places, "0123456789abcdef", "abdefghiklmnoprs")
    for script, letters in (("Cyrillic", "абвгдезиклмнопрс"), ("Greek", "αβγδεζηθικλμνξοπ"),
                            ("Armenian", "աբգդեզէըթիլխծկհղ"), ("Georgian", "აბგდევზთიკლმნოპჟ")):
        code = F.when(norm.rlike(rf"\p{{Is{script}}}"), F.translate(places, "0123456789abcdef", letters)).otherwise(code)
    decimal = F.lpad(number.cast("string"), 3 * digits, "0")
    body = F.concat(drawn, decimal)
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    card = F.when(luhn_sum(norm) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(body)
    # octets that no address has, one more than needed for each place beyond the first two
    octet = lambda i: (F.floor(number / 256 ** i).cast("bigint") % 256 + 1000 * (digits - 1) + 300).cast("string")
    last = F.substring(drawn, F.length(drawn), F.lit(1))
    stem = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
    return (F.when(kind == "ip", F.concat_ws(".", *[octet(i) for i in (3, 2, 1, 0)]))
            .when(kind == "card", card).when(kind == "phone", body).when(kind == "email", F.concat(code, drawn))
            .when(kind.isin("given_f", "given_m", "given"), F.concat(stem, code, last)).otherwise(F.concat(drawn, code)))


def _shaped(kind: Column, value: Column, new: Column) -> Column:
    """The surrogate in the format of a mention: its separators and its case."""
    filled = F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substring(
        new, F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), "[^0-9]", "")), F.lit(1))).otherwise(c)), "")
    cased = (F.when(value == F.upper(value), F.upper(new)).when(value == F.lower(value), new)
             .when(kind == "email", new).otherwise(F.initcap(new)))
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    filled = F.concat(filled, F.substring(new, digits + 1, F.length(new)))  # of a surrogate with more digits
    return F.when(kind.isin("phone", "card"), filled).when(kind == "ip", new).otherwise(cased)


def replace_personal_data(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``new_text`` and ``changes`` (ordered structs of start, end, kind and with).

    A null text stays null without changes; so does a text without mentions. Equal texts are worked out once; an
    entity may be mentioned by any share of all rows. Runs jobs when called.
    """
    kept = [c for c in docs.columns if c not in ("new_text", "changes")]
    text = F.col("text")
    key_columns = [F.xxhash64(F.lit(1), text).alias("__k1"), F.xxhash64(F.lit(2), text).alias("__k2")]
    found = docs.where(may_mention(text)).select(*key_columns, mentions(text).alias("m"))
    found = found.select("__k1", "__k2", F.explode("m").alias("m")).select("__k1", "__k2", "m.*").distinct()
    found = store(found, "mentions")
    # a given name after a title of either gender is the one that another mention tells the gender of
    told = found.where(F.col("kind").isin("given_f", "given_m")).groupBy("norm").agg(F.min("kind").alias("__told"))
    told = told.withColumn("kind", F.lit("given"))
    found = found.join(told, ["kind", "norm"], "left").withColumn("kind", F.coalesce("__told", "kind")).drop("__told")
    entities = store(found.select("kind", "norm").distinct(), "entities")
    named = found.join(assign(entities, key), ["kind", "norm"])
    change = F.struct("start", "end", "kind", _shaped(F.col("kind"), F.col("value"), F.col("surrogate")).alias("with"))
    changes = store(named.groupBy("__k1", "__k2").agg(F.array_sort(F.collect_list(change)).alias("changes")), "changes")
    rows = docs.select(*kept, *key_columns)
    none = F.expr("cast(array() as array<struct<start:int,end:int,kind:string,with:string>>)")
    hit = may_mention(text)
    plain = rows.where(~hit).withColumn("changes", none)
    changed = rows.where(hit).join(changes, ["__k1", "__k2"], "left").select(
        *kept, "__k1", "__k2", F.coalesce("changes", none).alias("changes"))
    both = plain.union(changed)
    return both.select(*kept, replace_spans(text, F.col("changes")).alias("new_text"), "changes")
