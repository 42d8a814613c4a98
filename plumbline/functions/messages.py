"""Text out of message lists, and chat templates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

from plumbline import schemas
from plumbline.functions.text import strip


def _messages(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.VariantType):
        return F.try_variant_get(c, "$", schemas.MESSAGES)
    return c


def _last(c: Column) -> Column:
    return F.get(F.reverse(c), F.lit(0))


def last_text(c: Column, dtype: T.DataType) -> Column:
    """Content of the last message, or the plain string; stripped.

    An empty list or a null text gives null, so the caller can count rejects.
    """
    if isinstance(dtype, T.StringType):
        return strip(c)
    text = _last(_messages(c, dtype))["content"]
    if isinstance(dtype, T.VariantType):
        plain = F.when(F.schema_of_variant(c) == "STRING", F.try_variant_get(c, "$", "string"))
        text = F.coalesce(plain, text)
    return strip(text)


def last_user_text(c: Column, dtype: T.DataType) -> Column:
    """Content of the last user message, else of the last message; as it stands."""
    if isinstance(dtype, T.StringType):
        return c
    msgs = _messages(c, dtype)
    user = _last(F.filter(msgs, lambda m: m["role"] == "user"))
    text = F.when(F.isnotnull(user), user["content"]).otherwise(_last(msgs)["content"])
    if isinstance(dtype, T.VariantType):
        plain = F.when(F.schema_of_variant(c) == "STRING", F.try_variant_get(c, "$", "string"))
        text = F.coalesce(plain, text)
    return text


@dataclass(frozen=True)
class ChatTemplate:
    """A chat template as data: the literals around the turns."""

    bos: str = "<s>"
    user_prefix: str = "[INST] "
    user_suffix: str = " [/INST]"
    assistant_prefix: str = " "
    assistant_suffix: str = "</s>"

    def prompt(self, user: Column) -> Column:
        return F.concat(F.lit(self.bos + self.user_prefix), user, F.lit(self.user_suffix))

    def dialogue(self, user: Column, assistant: Column) -> Column:
        return F.concat(
            self.prompt(user),
            F.lit(self.assistant_prefix),
            assistant,
            F.lit(self.assistant_suffix),
        )


def chat_prompt(user: Column, template: ChatTemplate | None) -> Column:
    """Prompt ready for generation; without a template the plain form is used."""
    if template is None:
        return F.concat(F.lit("User: "), user, F.lit("\nAssistant:"))
    return template.prompt(user)
