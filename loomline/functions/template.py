"""Chat templates and prompts as columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SYSTEM_PROMPT = "You teach machine learning. Explain clearly and correctly, with code where it helps."
GENERATION_PROMPT = (
    "Write one question and its answer about the text below, for students. Answer with one JSON object that has the keys "
    "concept, difficulty (Beginner, Intermediate or Advanced), instruction and response, and nothing else.\n\nText:\n"
)


@dataclass(frozen=True)
class Template:
    """What stands before a conversation, before a message's role, between role and content, and after the content."""

    begin: str
    role: str
    content: str
    end: str


CHATML = Template("", "<|im_start|>", "\n", "<|im_end|>\n")
LLAMA3 = Template("<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>\n\n", "<|eot_id|>")


def render(messages: list[tuple[str, Column | str]], template: Template = CHATML, generation_prompt: bool = False) -> Column:
    """messages: (role, content). generation_prompt: an assistant's header at the end."""
    parts = [F.lit(template.begin)]
    for role, content in messages:
        text = F.lit(content) if isinstance(content, str) else content
        parts += [F.lit(template.role + role + template.content), text, F.lit(template.end)]
    if generation_prompt:
        parts.append(F.lit(template.role + "assistant" + template.content))
    return F.concat(*parts)


def chat_text(instruction: Column, response: Column, system: str = SYSTEM_PROMPT, template: Template = CHATML) -> Column:
    from .text import strip

    return render([("system", system), ("user", strip(instruction)), ("assistant", strip(response))], template)


def question_prompt(instruction: Column, system: str = SYSTEM_PROMPT, template: Template = CHATML) -> Column:
    return render([("system", system), ("user", instruction)], template, generation_prompt=True)


def chunk_prompt(chunk: Column) -> Column:
    return F.concat(F.lit(GENERATION_PROMPT), chunk)
