"""Generation as an interface: prompts in, answers out.

A generator is a function from texts to answers (None: no answer). It runs in
Arrow batches on the executors, with a bounded number of attempts a row.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.template import chunk_prompt


def answers(chunks: DataFrame, generator: Callable[[str], str | None], chunk: str = "source_chunk", attempts: int = 3, delay: float = 0.0, out: str = "answer") -> DataFrame:
    """chunks with an answer each; a generator that raises or returns nothing is asked again, up to `attempts` times."""

    @F.pandas_udf("string")
    def run(prompts):
        def one(prompt):
            for k in range(attempts):
                try:
                    said = generator(prompt)
                except Exception:
                    said = None
                if said:
                    return said
                if delay and k + 1 < attempts:
                    time.sleep(delay)
            return None

        return prompts.map(one)

    return chunks.withColumn(out, run(chunk_prompt(F.col(chunk))))


def stub(prompt: str) -> str:
    """A generator for tests: the same answer for the same prompt."""
    body = prompt.rsplit("Text:\n", 1)[-1]
    topic = " ".join(body.split()[:3])
    return "```json\n" + json.dumps({"concept": topic, "difficulty": "Beginner", "instruction": f"What is said about {topic}?", "response": body * (1 + 200 // max(1, len(body)))}) + "\n```"
