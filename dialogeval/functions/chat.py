"""Chat messages and their rendering as text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def message(role: str, content: Column) -> Column:
    return F.struct(content.alias("content"), F.lit(role).alias("role"))


def chat_messages(system: Column, user: Column, assistant: Column) -> Column:
    """One training conversation: system, user, assistant."""
    return F.array(message("system", system), message("user", user), message("assistant", assistant))


def make_prompt(user: Column, system: Column | None = None) -> Column:
    """Prompt messages; an empty or missing system prompt is left out."""
    bare = F.array(message("user", user))
    if system is None:
        return bare
    full = F.array(message("system", system), message("user", user))
    return F.when(F.coalesce(F.length(system), F.lit(0)) > 0, full).otherwise(bare)


@dataclass(frozen=True)
class ChatTemplate:
    """Text around each role and content. The defaults are the ChatML layout."""

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    after_content: str = "<|im_end|>\n"
    generation_prompt: str = "<|im_start|>assistant\n"


CHATML = ChatTemplate()


def render_chat(
    messages: Column, template: ChatTemplate = CHATML, add_generation_prompt: bool = False
) -> Column:
    """Apply a chat template to an array of messages; a missing content renders as empty."""
    turns = F.transform(
        messages,
        lambda m: F.concat(
            F.lit(template.before_role),
            m["role"],
            F.lit(template.after_role),
            F.coalesce(m["content"], F.lit("")),
            F.lit(template.after_content),
        ),
    )
    text = F.array_join(turns, "")
    return F.concat(text, F.lit(template.generation_prompt)) if add_generation_prompt else text
