"""Message lists and chat layouts. A layout is data; rendering is one column expression."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import Column
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")


@dataclass(frozen=True)
class ChatTemplate:
    """How one model family writes a message list.

    ``opening`` maps a role to the text before its content, ``closing`` follows every message,
    ``generation_opening`` asks for an answer. A complete conversation has ``last_closing`` after
    its last message (None: the same closing) and ends with ``end_of_text``.
    """

    name: str
    opening: Mapping[str, str] = field(hash=False)
    closing: str
    generation_opening: str
    end_of_text: str = ""
    last_closing: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "opening", MappingProxyType(dict(self.opening)))


# Marker names of the two layouts. The line breaks of PHI3 are ours.
PHI3 = ChatTemplate(
    name="phi3",
    opening={"system": "<|system|>\n", "user": "<|user|>\n", "assistant": "<|assistant|>\n"},
    closing="<|end|>\n",
    generation_opening="<|assistant|>\n",
    end_of_text="<|endoftext|>",
)
CHATML = ChatTemplate(
    name="chatml",
    opening={role: f"<|im_start|>{role}\n" for role in ROLES},
    closing="<|im_end|>\n",
    generation_opening="<|im_start|>assistant\n",
    last_closing="<|im_end|>",
)
TEMPLATES = {template.name: template for template in (PHI3, CHATML)}


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def prompt_messages(system_prompt: str, user: Column) -> Column:
    """System and user message."""
    return F.array(message("system", F.lit(system_prompt)), message("user", user))


def full_messages(system_prompt: str, user: Column, reply: Column) -> Column:
    """The prompt messages and the assistant's reply."""
    return F.concat(prompt_messages(system_prompt, user), F.array(message("assistant", reply)))


def render(messages: Column, template: ChatTemplate, ask: bool) -> Column:
    """Write a message list in a template's layout; ``ask`` ends it with the generation marker.

    A role the template has no opening for fails the query instead of losing its content.
    """

    def opening(role: Column) -> Column:
        chosen = F.raise_error(F.concat(F.lit(f"{template.name} has no marker for role "), role))
        for name, text in template.opening.items():
            chosen = F.when(role == name, F.lit(text)).otherwise(chosen.cast("string"))
        return chosen

    written = F.transform(messages, lambda m: F.concat(opening(m["role"]), m["content"]))
    last = template.closing if ask or template.last_closing is None else template.last_closing
    ending = template.generation_opening if ask else template.end_of_text
    closed = F.when(F.size(messages) > 0, F.lit(last)).otherwise(F.lit(""))
    return F.concat(F.array_join(written, template.closing), closed, F.lit(ending))


def chatml_prompt(system_prompt: str, user: Column) -> Column:
    """Prompt for a model without a template of its own."""
    opening, closing = CHATML.opening, CHATML.closing
    return F.concat(
        F.lit(f"{opening['system']}{system_prompt}{closing}{opening['user']}"),
        user,
        F.lit(f"{closing}{CHATML.generation_opening}"),
    )


def chatml_text(prompt: Column, reply: Column) -> Column:
    """Complete ChatML conversation; no line break after the last marker."""
    return F.concat(prompt, reply, F.lit(CHATML.last_closing))
