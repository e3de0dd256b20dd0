"""Message lists and prompt rendering."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from kiln.constants import CHAT_TEMPLATE
from kiln.functions.text import TOKEN_PATTERN, token_count

__all__ = [
    "MSG_TYPE", "msg", "messages", "fill_template", "render_chat", "chat_token_count",
    "numbered_list", "prefill", "literal_token_count", "chat_overhead",
]

MSG_TYPE = "array<struct<role:string,content:string>>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def msg(role, content) -> Column:
    """One message ``struct<role, content>``; ``role`` may be a literal string."""
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.alias("role"), _c(content).cast("string").alias("content"))


def messages(*pairs) -> Column:
    """``messages(("system", sys_col), ("user", "prompt"))`` -> array of messages."""
    return F.array(*[msg(r, c) for r, c in pairs])


def fill_template(template: str, **slots) -> Column:
    """Fill ``{SLOT}`` markers of a fixed template from columns or literals."""
    out = F.lit(template)
    for name, value in slots.items():
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.replace(out, F.lit("{" + name + "}"), v)
    return out


def render_chat(msgs, template: dict = CHAT_TEMPLATE, add_generation_prompt: bool = True) -> Column:
    """Render a message list to one prompt string with a configurable template."""
    body = F.array_join(
        F.transform(_c(msgs), lambda m: F.concat(
            F.lit(template["begin"]), m["role"], F.lit("\n"),
            F.coalesce(m["content"], F.lit("")), F.lit(template["end"]))),
        "")
    if add_generation_prompt:
        body = F.concat(body, F.lit(template["generation"]))
    return body


_TOKEN_RE = re.compile(TOKEN_PATTERN.replace("\\x0B", "\\x0b"))


def literal_token_count(s: str) -> int:
    return len(_TOKEN_RE.findall(s))


def _is_boundary(ch: str) -> bool:
    return not re.match("[A-Za-z0-9_]", ch)


def chat_token_count(msgs, template: dict = CHAT_TEMPLATE, add_generation_prompt: bool = True) -> Column:
    """Token count of ``render_chat(msgs)`` without building the rendered string.

    Valid because every template piece starts and ends on a non-word character,
    so no token spans two pieces (checked below; rendering is the fallback).
    """
    pieces = [template["begin"], template["end"], template["generation"]]
    if not all(p and _is_boundary(p[0]) and _is_boundary(p[-1]) for p in pieces):
        return token_count(render_chat(msgs, template, add_generation_prompt))
    begin = literal_token_count(template["begin"])
    end = literal_token_count(template["end"])
    per_msg = F.aggregate(
        F.transform(_c(msgs), lambda m: token_count(m["role"]) + token_count(m["content"])),
        F.lit(0), lambda acc, x: acc + x)
    total = per_msg + F.size(_c(msgs)) * F.lit(begin + end)
    if add_generation_prompt:
        total = total + F.lit(literal_token_count(template["generation"]))
    return total


def chat_overhead(roles: list[str], template: dict = CHAT_TEMPLATE, add_generation_prompt: bool = True) -> int:
    """Tokens the template adds around messages with the given roles (contents excluded)."""
    n = sum(literal_token_count(template["begin"] + r + "\n") + literal_token_count(template["end"]) for r in roles)
    return n + (literal_token_count(template["generation"]) if add_generation_prompt else 0)


def numbered_list(arr, sep: str = "\n", start: int = 1, fmt: str = ". ") -> Column:
    """``"1. q1\\n2. q2\\n"`` from an array (each item followed by ``sep``)."""
    items = F.transform(_c(arr), lambda x, i: F.concat((i + start).cast("string"), F.lit(fmt), x, F.lit(sep)))
    return F.array_join(items, "")


def prefill(prompt, text) -> Column:
    """Append a prefill text to a rendered prompt."""
    return F.concat(_c(prompt), _c(text))
