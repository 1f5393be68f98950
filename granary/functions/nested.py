"""JSON replies, envelopes, chat messages and figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.text import IMAGE, strip

GROUP = "struct<authoritative_answer:string,answer:string,alternative_questions:array<string>,question:string,variations:array<struct<question:string,answer:string>>>"
GROUPS = f"array<{GROUP}>"
ENVELOPE = "struct<key:string,error:string,response:struct<candidates:array<struct<content:struct<parts:array<struct<text:string>>>>>>>"
MESSAGES = "struct<messages:array<struct<role:string,content:string>>>"


def valid_json(text: Column) -> Column:
    """The text if it is JSON, else null."""
    return F.when(F.try_parse_json(text).isNotNull(), text)


def salvage_json(reply: Column) -> Column:
    """The JSON text of a reply: all of it, else its first fenced block, else from the first bracket to the last; or null."""
    bare = strip(reply)
    fenced = strip(F.regexp_extract(bare, r"(?s)```(?:json)?\s*(.*?)\s*```", 1))
    # A regular expression of alternatives would begin at whichever bracket comes first; so does this one.
    bracketed = F.regexp_extract(bare, r"(?s)(\{.*\}|\[.*\])", 1)
    return F.coalesce(valid_json(bare), valid_json(fenced), valid_json(bracketed))


def split_segments(text: Column) -> Column:
    """array<struct<kind, body>>: the texts and embedded images of a text in order, texts that are blank left out."""
    parts, images = F.split(text, IMAGE, -1), F.regexp_extract_all(text, F.lit(f"({IMAGE})"))
    both = F.flatten(F.transform(parts, lambda p, i: F.array(F.struct(F.lit("text").alias("kind"), p.alias("body")), F.struct(F.lit("image").alias("kind"), F.get(images, i).alias("body")))))
    return F.filter(both, lambda s: s["body"].isNotNull() & ((s["kind"] == "image") | (strip(s["body"]) != "")))


def groups_json(reply: Column) -> Column:
    """A reply's JSON array of groups: what it has under qna_groups, else its first list under any key; null if there is none."""
    named = F.get_json_object(reply, "$.qna_groups")
    keys = F.json_object_keys(reply)
    lists = F.filter(F.transform(keys, lambda k: F.call_function("get_json_object", reply, F.concat(F.lit("$['"), k, F.lit("']")))), lambda v: F.startswith(F.ltrim(v), F.lit("[")))
    return F.coalesce(named, F.get(lists, F.lit(0)))


def caption_list(reply: Column, count: Column) -> Column:
    """The captions of a reply between its first and last bracket, stripped; blank ones where it has another number of them or none."""
    found = F.from_json(F.regexp_extract(reply, r"(?s)\[.*\]", 0), "array<string>")
    blank = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.lit(""))
    return F.when(F.size(found) == count, F.transform(found, lambda c: strip(F.coalesce(c, F.lit(""))))).when(count > 0, blank).otherwise(F.array().cast("array<string>"))


def captions(reply: Column, count: Column) -> Column:
    """A JSON array of exactly `count` captions, else null."""
    found = F.from_json(reply, "array<string>")
    return F.when(F.size(found) == count, found)


def envelope(key: Column, text: Column) -> Column:
    """A reply in the shape of a batch result."""
    part = F.array(F.named_struct(F.lit("text"), text))
    content = F.named_struct(F.lit("content"), F.named_struct(F.lit("parts"), part))
    return F.to_json(F.named_struct(F.lit("key"), key, F.lit("response"), F.named_struct(F.lit("candidates"), F.array(content))))


def first_content(messages: Column, roles: tuple[str, ...]) -> Column:
    """The stripped content of the first message with one of the roles, null if there is none."""
    found = F.filter(messages, lambda m: m["role"].isin(*roles))
    return F.when(F.size(found) > 0, strip(F.coalesce(found[0]["content"], F.lit(""))))


def chat_text(messages: Column) -> Column:
    """Messages as turns of a user and a model; any role but assistant and model is the user."""
    turn = lambda m: F.concat(
        F.lit("<start_of_turn>"), F.when(m["role"].isin("assistant", "model"), F.lit("model")).otherwise(F.lit("user")),
        F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit("<end_of_turn>\n"),
    )
    return F.array_join(F.transform(messages, turn), "")


def trainable_spans(chat: Column) -> Column:
    """(start, length) of the model's turns in a chat text, counted in characters from 1, end mark included."""
    pieces = F.split(chat, "<start_of_turn>model\n", -1)
    lead = len("<start_of_turn>model\n")
    ends = F.transform(pieces, lambda p: F.when(F.instr(p, "<end_of_turn>\n") > 0, F.instr(p, "<end_of_turn>\n") + F.lit(len("<end_of_turn>\n") - 1)).otherwise(F.length(p)))
    before = F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda i: F.aggregate(F.slice(pieces, F.lit(1), i - 1), F.lit(0), lambda s, p: s + F.length(p) + lead))
    spans = F.zip_with(before, ends, lambda b, e: F.struct((b + 1).alias("start"), e.alias("length")))
    return F.slice(spans, F.lit(2), F.greatest(F.size(spans) - 1, F.lit(0)))


def interleave_figures(text: Column, notes: Column) -> Column:
    """Embedded images of a text replaced in order by [FIGURE n: note], n from 0; a missing or blank note has a stock text."""
    parts = F.split(text, IMAGE, -1)
    stock = F.lit("visual asset present in the original book page")
    note = lambda i: F.coalesce(F.nullif(strip(F.coalesce(F.try_element_at(notes, i), F.lit(""))), F.lit("")), stock)
    whole = F.transform(parts, lambda p, i: F.concat(F.when(i > 0, F.concat(F.lit("\n[FIGURE "), (i - 1).cast("string"), F.lit(": "), note(i), F.lit("]\n"))).otherwise(F.lit("")), F.when(strip(p) != "", p).otherwise(F.lit(""))))
    return F.array_join(whole, "")


def choose_option(options: Column, wanted: Column) -> Column:
    """The value of the first option whose text contains `wanted` or whose value is it, leading zeros aside; else the first's."""
    want = F.lower(strip(wanted))
    bare = F.regexp_replace(want, "^0+", "")
    fits = F.filter(options, lambda o: F.contains(F.lower(strip(o["text"])), want) | F.lower(strip(o["value"])).isin(want, bare))
    return F.coalesce(F.try_element_at(fits, F.lit(1))["value"], F.try_element_at(options, F.lit(1))["value"], F.lit(""))
