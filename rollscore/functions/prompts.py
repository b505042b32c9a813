"""Prompt templates and chat wrapping (P3-P8) as string Columns.

Templates are filled with ``concat`` of literals and columns, not
``format_string`` (no locale, no float rounding): ``{numbers}`` renders like
Python's ``str(list)`` and ``{target}`` like ``str(int)``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col
from .text import py_strip

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference, byte for byte (note the trailing
# space after "{target}." in A and B, and its absence in E).
# ---------------------------------------------------------------------------
TEMPLATE_A = (
    "Using the numbers {numbers}, create an equation that equals {target}. \n"
    "You can use basic arithmetic operations (+, -, *, /) and each number can only be used once.\n"
    "Show your reasoning in <think> </think> tags. And return the final equation in <answer> </answer> tags. "
    "Keep your reasoning under {max_tokens} tokens.\n"
    "For example, numbers = [1, 2, 3, 4] and target = 5, the answer is <answer>(1 + 2) * 3 - 4</answer>."
)
TEMPLATE_B = (
    "Using the numbers {numbers}, create an equation that equals {target}. \n"
    "You can use basic arithmetic operations (+, -, *, /) and each number can only be used ONCE.\n"
    "Show your reasoning in <think> </think> tags. And return the final equation in <answer> </answer> tags. "
    "Keep your reasoning under {max_tokens} tokens.\n"
    "For example, using the numbers [1, 2, 3, 4], create an equation that equals 5. "
    "The answer is <answer>(1 + 2) * 3 - 4</answer>."
)
TEMPLATE_D = (
    'You are solving a math puzzle called "Countdown". \n'
    "\n"
    "Task: Using the numbers {numbers}, create an equation that equals {target}.\n"
    "Rules:\n"
    "- You can use basic arithmetic operations (+, -, *, /)\n"
    "- Each number must be used exactly once\n"
    "- You can use parentheses\n"
    "\n"
    "Format your response EXACTLY like this:\n"
    "<think>\n"
    "[Your step-by-step reasoning here - keep it concise, under 100 words]\n"
    "</think>\n"
    "\n"
    "<answer>[equation]</answer>\n"
    "\n"
    "Now solve this:\n"
    "Numbers: {numbers}, Target: {target}"
)
TEMPLATE_C = TEMPLATE_A.replace("{max_tokens}", "256")
TEMPLATE_E = TEMPLATE_A.replace("{target}. \n", "{target}.\n")
SYSTEM_PROMPT = "You are a helpful assistant."

TEMPLATES = {"A": TEMPLATE_A, "B": TEMPLATE_B, "C": TEMPLATE_C, "D": TEMPLATE_D, "E": TEMPLATE_E}

# ChatML-style turn layout (the default of the chat models used); callers may
# pass their own ``turn`` and ``generation_prompt``.
CHATML_TURN = "<|im_start|>{role}\n{content}<|im_end|>\n"
CHATML_GENERATION = "<|im_start|>assistant\n"

_PLACEHOLDER = re.compile(r"\{(numbers|target|max_tokens)\}")


def py_list(nums) -> Column:
    """``str(list_of_ints)``, e.g. ``[79, 17, 60]``."""
    return F.concat(
        F.lit("["), F.array_join(F.transform(as_col(nums), lambda x: x.cast("string")), ", "), F.lit("]")
    )


def fill_template(template: str, numbers="nums", target="target", max_tokens: int | None = 256) -> Column:
    """Fill ``{numbers}``, ``{target}``, ``{max_tokens}`` of a template."""
    values = {
        "numbers": py_list(numbers),
        "target": as_col(target).cast("string"),
        "max_tokens": F.lit(str(max_tokens)),
    }
    parts: list[Column] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(values[m.group(1)])
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def prompt(variant: str = "A", numbers="nums", target="target", max_tokens: int = 256) -> Column:
    """P3 by variant name (A-E, see SURVEY 2.11)."""
    return fill_template(TEMPLATES[variant], numbers, target, max_tokens)


def chat_messages(user_content: Column, system: str = SYSTEM_PROMPT) -> Column:
    """P5: ``[{role: system, ...}, {role: user, ...}]``."""
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(F.lit("user").alias("role"), user_content.alias("content")),
    )


def render_chat(messages, turn: str = CHATML_TURN, generation_prompt: str = CHATML_GENERATION) -> Column:
    """P5: render messages with a role/turn template, then the generation prompt."""
    before, rest = turn.split("{role}", 1)
    middle, after = rest.split("{content}", 1)
    rendered = F.transform(
        as_col(messages),
        lambda m: F.concat(F.lit(before), m["role"], F.lit(middle), m["content"], F.lit(after)),
    )
    return F.concat(F.array_join(rendered, ""), F.lit(generation_prompt))


def chat_prompt(user_content: Column, system: str = SYSTEM_PROMPT, **kw) -> Column:
    """P5 in one call."""
    return render_chat(chat_messages(user_content, system), **kw)


def ground_truth(target="target", nums="nums") -> Column:
    """``{target: DOUBLE, numbers: nums}``."""
    return F.struct(as_col(target).cast("double").alias("target"), as_col(nums).alias("numbers"))


def sft_text_plain(prompt_col: Column, completion) -> Column:
    """``f"{prompt}\\n\\n{completion}"`` (a NULL prints as ``None``)."""
    return F.concat(prompt_col, F.lit("\n\n"), F.coalesce(as_col(completion), F.lit("None")))


def sft_text_chat(chat: Column, completion) -> Column:
    """Chat-wrapped prompt followed by the stripped completion."""
    return F.concat(chat, py_strip(as_col(completion)))
