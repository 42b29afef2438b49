"""Redaction and other text rules of messages, as columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens that stand for what was masked, and the fields whose values are masked (long names first).
MASK_PHONE, MASK_FIELD, MASK_AT = "<手机号>", "<略>", "@某人"
FIELDS = "客户姓名|客户电话|客户旺旺|订单区域|所在地区|详细地址|收货人|收件人|联系人|客户|地址"
PLACEHOLDERS = {"IMAGE": "[图片]", "GIF": "[表情]", "VIDEO": "[视频]"}

# The longest name that a mention masks, the longest note in brackets after it, and what else is looked for.
NAME, NOTE = 12, 40
PHONE = r"(?<![0-9])1[3-9][0-9]{9}(?:-[0-9]{4})?(?![0-9])"
ORDER = r"[A-Za-z]{0,6}[0-9]{16,}"
NOISE = f"{MASK_PHONE}|{MASK_FIELD}|{MASK_AT}|{ORDER}"


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _unquoted(t: Column) -> Column:
    """Without what it quotes: a head in quotation marks, named in its first line, closed before a rule of hyphens."""
    named = F.locate("：\n", t, 3)
    after = lambda x: F.when(F.size(x) == 2, F.get(x, F.lit(1))).otherwise(t)
    cut = _with(F.split(F.substr(t, named + 2), '"\n-+\n', 2), after)
    return F.when(F.startswith(t, F.lit('"')) & (named > 0), cut).otherwise(t)


def _mention(p: Column) -> Column:
    """What follows an at sign: a name and perhaps a note in brackets give way to the token, anything else stays."""
    stop = F.regexp_instr(p, F.lit(r"(?U)[\s(（]"))
    name = F.least(F.when(stop > 0, stop - 1).otherwise(F.length(p)), F.lit(NAME))
    rest = F.substr(p, name + 1)
    close = F.regexp_instr(rest, F.lit("[)）]"))
    noted = F.left(rest, F.lit(1)).isin("(", "（") & close.between(2, NOTE + 2)
    kept = F.regexp_replace(F.when(noted, F.substr(rest, close + 1)).otherwise(rest), r"(?U)^\s+", "")
    return F.when(name == 0, F.concat(F.lit("@"), p)).otherwise(F.concat(F.lit(f"{MASK_AT} "), kept))


def _unnamed(t: Column) -> Column:
    pieces = F.transform(F.split(t, "@"), lambda p, i: F.when(i == 0, p).otherwise(_mention(p)))
    return F.when(F.contains(t, F.lit("@")), F.array_join(pieces, "")).otherwise(t)


def _one_line(t: Column) -> Column:
    """Lines, trimmed, joined by a slash; blank ones stay only at the ends."""
    lines = F.transform(F.split(t, "[\r\n]"), trimmed)
    inner = _with(lines, lambda x: F.filter(x, lambda line, i: (line != "") | (i == 0) | (i == F.size(x) - 1)))
    return F.when(F.contains(t, F.lit("\n")) | F.contains(t, F.lit("\r")), F.array_join(inner, " / ")).otherwise(t)


def _without_fields(t: Column) -> Column:
    """Between slashes, what follows the first field name and colon is masked."""

    def masked(parts: Column) -> Column:
        def one(p: Column, i: Column) -> Column:
            head = F.regexp_extract(p, f"(?s)^.*?(?:{FIELDS})[:：]", 0)
            tail = F.when(i < F.size(parts) - 1, F.regexp_extract(p, r"(?U)\s*\z", 0)).otherwise("")
            return F.when(head == "", p).otherwise(F.concat(head, F.lit(MASK_FIELD), tail))

        return F.array_join(F.transform(parts, one), "/")

    named = F.contains(t, F.lit(":")) | F.contains(t, F.lit("："))
    return F.when(named, _with(F.split(t, "/"), masked)).otherwise(t)


def redacted(c: Column) -> Column:
    """The text as a model may see it. The order counts: quoted head, mentions, phones, line breaks, labelled fields.

    A note after a mention ends at the next at sign at the latest.
    """
    steps = [_unquoted, _unnamed, lambda t: F.regexp_replace(t, PHONE, MASK_PHONE), _one_line, _without_fields, trimmed]
    return reduce(_with, steps, c)


def first_phone(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, PHONE, 0), F.lit(""))


def first_order(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, ORDER, 0), F.lit(""))


def without_noise(c: Column) -> Column:
    """A summary without mask tokens and order numbers, its white space joined."""
    return trimmed(F.regexp_replace(F.regexp_replace(c, NOISE, " "), r"(?U)\s+", " "))


def non_blank(c: Column) -> Column:
    t = trimmed(c)
    return F.when(t != "", t)


def shown(text: Column, kind: Column) -> Column:
    """Text of a message, a fixed one for pictures and films; other kinds pass."""
    return reduce(lambda c, kv: c.when(kind == kv[0], kv[1]), PLACEHOLDERS.items(), F.when(F.lit(False), text)).otherwise(text)


def long_id(c: Column) -> Column:
    """An unsigned 64-bit id given as a number or as text."""
    return c.cast("decimal(20,0)")


def duration(seconds: Column) -> Column:
    """Seconds as 45s, 12m 5s or 3h 2m; null stays null."""
    s = seconds.cast("long")
    return F.when(s < 60, F.concat(s, F.lit("s"))).when(s < 3600, F.concat(F.expr("1") * (s / 60).cast("long"), F.lit("m "), s % 60, F.lit("s"))).when(s.isNotNull(), F.concat((s / 3600).cast("long"), F.lit("h "), ((s % 3600) / 60).cast("long"), F.lit("m")))
