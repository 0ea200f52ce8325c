"""Secret scanning with multipart credential linking.

Base kinds are reported wherever they match. Identifiers, secrets and endpoints that are too weak to report alone are
reported when complementary parts lie in one scope (a stretch of text without a blank line): an identifier with a
secret, or a secret with an endpoint. Parts and scopes are interval-joined over bins of text positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import SPAN, match_spans, replace_spans, store

# The base patterns, in the order in which kinds of equal start are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LONG_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{12,})"""
# A run that is long enough is matched by the bounded pattern exactly where the unbounded one matches it.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# Weak parts: named identifiers, short or unnamed secrets, endpoints. A name may have a prefix of words (DB_, aws-, awsDev);
# the prefix is bounded, and a longer one is left before the match.
_PREFIX = r"""(?i)(?<![A-Za-z0-9])(?:[A-Za-z0-9]{1,32}+[_-]){0,4}(?-i:[A-Z]?[a-z0-9]{1,16}+(?=[A-Z])){0,4}"""
_IS = r"""["']?[\x20\t]*[:=][\x20\t]*["']?"""
IDENTIFIER = _PREFIX + r"""(?:(?<!secret)(?<!secret[_-])access[_-]?key(?:[_-]?id)?|key[_-]?id|(?:client|account|app|application|tenant|user)[_-]?id|(?:user|account|login)[_-]?name|user|uid|login|e?mail)""" + _IS + r"""([A-Za-z0-9_.@+-]{3,})"""
WEAK_SECRET = _PREFIX + r"""(?:pwd|pass|pass[_-]?(?:phrase|code|word)|passwd|(?:private|auth|api|account|secret|(?:secret|shared)[_-]?access)[_-]?key|(?:client|app|consumer)[_-]?secret|(?:auth|access|refresh|session|api)[_-]?token|token|secret)""" + _IS + r"""([A-Za-z0-9+/_.=!@#$%^&*-]{4,})"""
ENDPOINT = r"""(?i)\b(?:https?|s?ftp|jdbc|postgres(?:ql)?|mysql|mariadb|mssql|sqlserver|rediss?|mongodb(?:\+srv)?|amqps?|ldaps?|smtps?)://[^\s"'<>]{4,}|""" + _PREFIX + r"""(?:host|host[_-]?name|hosts|server|endpoint|db[_-]?name|database|data[_-]?source|bucket|(?:base[_-]?|service[_-]?)?ur[il])""" + _IS + r"""[A-Za-z0-9._-]{3,}"""
KINDS = ("assign", "access", "hex", "part_id", "part_secret", "part_endpoint")
BIN = 4096
PLACED = "struct<start:int,kind:int,end:int>"
SCOPE = r"(?s).+?(?:\n[ \t\r]*\n|\z)"


def _placed(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Base spans as structs of start, kind number and end, in order."""
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    assign = F.when(text.rlike(LONG_ASSIGN), F.filter(
        match_spans(text, ASSIGN, 2), lambda x: F.length(x["value"]) >= 12)).otherwise(none)
    return F.array_sort(F.concat(
        _placed(assign, 0), _placed(match_spans(text, ACCESS), 1), _placed(match_spans(text, HEX), 2)))


def text_key(text: Column) -> list[Column]:
    """Two hashes that stand for a text: all spans follow from the text alone."""
    return [F.xxhash64(F.lit(1), text).alias("k1"), F.xxhash64(F.lit(2), text).alias("k2")]


def linked_parts(docs: DataFrame) -> DataFrame:
    """k1, k2 and the linked weak parts (ordered spans) of each distinct text that has any. Runs a job when called."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # a cheap test of the roles first: most texts have no secret with an identifier or an endpoint
    strong = text.rlike(LONG_ASSIGN) | text.rlike(HEX)
    secret = text.rlike(WEAK_SECRET) | strong
    other = text.rlike(IDENTIFIER) | text.rlike(ENDPOINT) | text.rlike(ACCESS)
    found = docs.where(other & secret).select(*text_key(text), text.alias("text"))
    base = base_spans(F.col("text"))
    parts = F.concat(base, _placed(match_spans(F.col("text"), IDENTIFIER), 3),
                     _placed(match_spans(F.col("text"), WEAK_SECRET), 4),
                     _placed(match_spans(F.col("text"), ENDPOINT), 5))
    blocks = F.regexp_extract_all("text", F.lit(SCOPE), F.lit(0))
    scopes = F.aggregate(
        F.transform(blocks, lambda x: F.length(x)),
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<low:int,high:int>>)").alias("out")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(F.struct(
            acc["at"].alias("low"), (acc["at"] + n).alias("high")))).alias("out")),
        lambda acc: acc["out"])
    found = found.select("k1", "k2", parts.alias("parts"), scopes.alias("scopes"))
    found = store(found.groupBy("k1", "k2").agg(F.first("parts").alias("parts"), F.first("scopes").alias("scopes")),
                  "parts")
    part = found.select("k1", "k2", F.explode("parts").alias("p")).select(
        "k1", "k2", "p.*", F.expr(f"p.start div {BIN}").alias("bin"))
    scope = found.select("k1", "k2", F.explode("scopes").alias("s")).select("k1", "k2", "s.*")
    scope = scope.withColumn("bin", F.explode(F.sequence(F.expr(f"low div {BIN}"), F.expr(f"(high - 1) div {BIN}"))))
    held = part.join(scope, ["k1", "k2", "bin"]).where("low <= start and start < high")
    roles = held.groupBy("k1", "k2", "low").agg(
        F.max(F.col("kind").isin(1, 3)).alias("id"), F.max(F.col("kind").isin(0, 2, 4)).alias("secret"),
        F.max(F.col("kind") == 5).alias("endpoint"))
    whole = roles.where("secret and (id or endpoint)").select("k1", "k2", "low")
    weak = held.where("kind >= 3").join(whole, ["k1", "k2", "low"], "left_semi")
    linked = weak.groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("linked"))
    return store(linked, "linked")


def secret_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: ordered structs of start, kind (number in KINDS) and end.

    A null text is empty and has no spans. ``spans`` are the base spans and the linked parts; a part that a base span
    covers is not told again. Repeated rows are treated alike. Positions are code points, ends exclusive.
    """
    kept = [c for c in docs.columns if c not in ("base", "spans")]
    text = F.coalesce(docs["text"], F.lit(""))
    k1, k2 = text_key(text)
    rows = docs.select(*kept, base_spans(text).alias("base"), k1.alias("__k1"), k2.alias("__k2"))
    linked = linked_parts(docs).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), "linked")
    rows = rows.join(linked.withColumnRenamed("linked", "__linked"), ["__k1", "__k2"], "left")
    new = F.filter(F.coalesce("__linked", F.expr(f"cast(array() as array<{PLACED}>)")), lambda x: ~F.exists(
        "base", lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"])))
    return rows.select(*kept, "base", F.array_sort(F.concat("base", new)).alias("spans"))


def told(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"], x["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with each stretch of overlapping spans replaced by ``mark``."""
    merged = F.aggregate(
        spans, F.expr("cast(array() as array<struct<start:int,end:int>>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start"] < F.element_at(acc, F.lit(-1))["end"]),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, F.lit(-1))["start"].alias("start"),
                F.greatest(F.element_at(acc, F.lit(-1))["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))))
    marked = F.transform(merged, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.lit(mark).alias("with")))
    return F.when(F.size(spans) > 0, replace_spans(text, marked)).otherwise(text)
