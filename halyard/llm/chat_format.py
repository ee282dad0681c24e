"""Chat formatting with typed content parts, in DataFrame operations only.

A turn's parts (text, image, audio, document) are flattened in order to one
content string: texts with their control characters escaped, attachments as
placeholders. Turns are joined to ``<turn:ROLE>CONTENT</turn>`` lines.

Escapes: ``\\`` is written ``\\b``, ``<`` ``\\l`` and ``>`` ``\\g``. So a
formatted text holds ``<`` and ``>`` only in the template's own marks, and a
backslash is always followed by b, l, g or a placeholder's letter; undoing l
and g first and b last gives every text back. A placeholder is ``\\i``,
``\\a`` or ``\\d``, the attachment's number in its conversation, and ``;``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.functions.text import bound

PART_TYPE = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens an attachment expands to: one for each begun image patch, each begun audio frame, and so many a page.
PATCH_PIXELS, FRAME_SECONDS, PAGE_TOKENS = 14, 0.04, 512
#: Letter of each attachment kind in placeholders.
LETTERS = {"image": "i", "audio": "a", "document": "d"}
OPEN, MIDDLE, CLOSE = "<turn:", ">", "</turn>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")), F.lit("\\b"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A content of one text part."""
    none = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in none.items()]))


def part_tokens(p: Column) -> Column:
    """Expanded tokens of an attachment; unknown sizes count as the least."""
    patches = F.greatest(F.ceil(F.coalesce(p["width"], F.lit(1)) / PATCH_PIXELS), F.lit(1)) * F.greatest(F.ceil(F.coalesce(p["height"], F.lit(1)) / PATCH_PIXELS), F.lit(1))
    frames = F.greatest(F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) / FRAME_SECONDS), F.lit(1))
    pages = F.greatest(F.coalesce(p["pages"], F.lit(1)), F.lit(1)) * PAGE_TOKENS
    return F.when(p["kind"] == "image", patches).when(p["kind"] == "audio", frames).when(p["kind"] == "document", pages).cast("long")


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conv_id: formatted, n_turns, attachments, expanded_tokens.

    turns: conv_id, turn, role, parts (array of PART_TYPE); other columns are
    ignored. Turns stand by turn, nulls first, ties by role and content, so
    repeated rows stay as repeated turns. Null roles, texts and contents count
    as empty, parts of unknown kind as nothing. attachments: kind, ref, turn
    number from 0, tokens, in the order of the placeholders. No rows, no rows.
    """
    letter = F.create_map(*[F.lit(x) for kv in LETTERS.items() for x in kv])
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART_TYPE}>"))
    # an attachment's place is marked by its letter until its number in the conversation is known
    visited = F.transform(parts, lambda p: F.when(p["kind"] == "text", escape(F.coalesce(p["text"], F.lit("")))).when(p["kind"].isin(*LETTERS), F.concat(F.lit("\\"), letter[p["kind"]], F.lit(";"))).otherwise(F.lit("")))
    found = F.transform(
        F.filter(parts, lambda p: p["kind"].isin(*LETTERS)),
        lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), part_tokens(p).alias("tokens")),
    )
    flat = turns.select(
        "conv_id",
        F.struct(
            "turn",
            escape(F.coalesce(F.col("role"), F.lit(""))).alias("role"),
            F.array_join(visited, "").alias("content"),
            found.alias("found"),
        ).alias("t"),
    )
    chats = flat.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    line = lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["content"], F.lit(CLOSE))
    attached = F.flatten(F.transform("turns", lambda t, i: F.transform(t["found"], lambda a: F.struct(a["kind"].alias("kind"), a["ref"].alias("ref"), i.alias("turn"), a["tokens"].alias("tokens")))))
    joined = chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", line), "").alias("joined"),
        attached.alias("attachments"),
    )
    # number the placeholders: pieces between the marks, each mark with the count of those before it
    pieces = F.split("joined", r"\\(?=[iad];)")
    numbered = F.array_join(F.transform(pieces, lambda p, k: F.when(k == 0, p).otherwise(F.concat(F.lit("\\"), F.substring(p, 1, 1), (k - 1).cast("string"), F.substr(p, F.lit(2))))), "")
    return joined.select(
        "conv_id",
        F.when(F.size("attachments") > 0, numbered).otherwise(F.col("joined")).alias("formatted"),
        "n_turns",
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """Turns of a formatted text: array of (role, text); placeholders are left out of texts."""
    plain = F.regexp_replace(formatted, r"\\[iad][0-9]+;", "")
    turn = F.lit(r"<turn:([^<>]*)>([^<>]*)</turn>\n")
    roles, bodies = F.regexp_extract_all(plain, turn, F.lit(1)), F.regexp_extract_all(plain, turn, F.lit(2))
    return F.zip_with(roles, bodies, lambda r, b: F.struct(unescape(r).alias("role"), unescape(b).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """What the loss mask covers of a formatted text, spans in order with nothing between, as the texts were: placeholders out, escapes undone."""
    covered = F.array_join(F.transform(spans, lambda s: F.substr(formatted, s["first"] + 1, s["length"])), "")
    return unescape(F.regexp_replace(covered, r"\\[iad][0-9]+;", ""))


def loss_spans(formatted: Column, loss_role: str = "assistant") -> Column:
    """Where the mask lies in a formatted text: (first, length) in characters from 0, escapes and placeholders included.

    Marks stand nowhere but in the template, so the text is cut at them.
    """
    role = lambda b: F.substring_index(F.substr(b, F.lit(len(OPEN) + 1)), MIDDLE, 1)
    head = len(OPEN) + len(loss_role) + len(MIDDLE)
    sized = F.transform(F.split(formatted, CLOSE), lambda b: F.struct((F.length(b) + len(CLOSE)).alias("n"), role(b).alias("role")))

    def spans(turns: Column) -> Column:
        placed = F.zip_with(turns, sums_before(F.transform(turns, lambda t: t["n"])), lambda t, at: F.struct(t["role"].alias("role"), (at + head).cast("int").alias("first"), (t["n"] - len(CLOSE) - head).cast("int").alias("length")))
        return F.transform(F.filter(placed, lambda t: t["role"] == loss_role), lambda t: F.struct(t["first"].alias("first"), t["length"].alias("length")))

    return bound(sized, spans)


def sums_before(numbers: Column, block: int = 256) -> Column:
    """The sum of all numbers before each; by blocks, so that no sum runs over the whole array for every number."""
    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    def within(own: Column) -> Column:
        n, base = own["numbers"], own["base"]
        at = lambda i: F.get(base, F.floor(i / block).cast("int")) + total(F.slice(n, (F.floor(i / block) * block + 1).cast("int"), i % block))
        return F.transform(n, lambda _, i: at(i))

    def blocks(n: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.floor(F.size(n) / block).cast("int")), lambda k: total(F.slice(n, k * block + 1, block)))
        return bound(sums, lambda s: bound(F.struct(n.alias("numbers"), F.transform(s, lambda _, k: total(F.slice(s, F.lit(1), k))).alias("base")), within))

    return bound(numbers, blocks)
