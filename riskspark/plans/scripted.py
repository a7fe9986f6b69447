"""A stand-in for a model client, for the registered queries and the tests only; no part of the library's API.

Its behaviour depends on the length of the prompt only, so that SQL can tell what it answers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence


class ScriptedClient:
    """Rules (divisor, answer) are tried in order on ``len(prompt)``; the first divisor that divides it decides.

    The answer ``None`` fails every time. A prompt whose length ``flaky`` divides fails twice before it is answered.
    ``{n}`` in an answer stands for the length.
    """

    def __init__(self, rules: Sequence[tuple[int, str | None]], flaky: int = 0):
        self.rules, self.flaky, self.seen = tuple(rules), flaky, Counter()

    def __call__(self, prompts: list[str]) -> list[str]:
        return [self._one(p) for p in prompts]

    def _one(self, prompt: str) -> str:
        n = len(prompt)
        if self.flaky and n % self.flaky == 0 and self.seen[prompt] < 2:
            self.seen[prompt] += 1
            raise RuntimeError("busy")
        del self.seen[prompt]
        for divisor, answer in self.rules:
            if n % divisor == 0:
                if answer is None:
                    raise RuntimeError("refused")
                return answer.replace("{n}", str(n))
        raise RuntimeError("no rule")


FIRST_PASS = ((11, None), (7, "moderate risk"), (3, " Bad Risk\n"), (1, "Good Risk"))
SECOND_PASS = ((22, None), (11, " GOOD risk\t"), (7, "moderate risk"), (1, "good risk"))
DESCRIBE_FIRST = ((11, None), (1, "A text of {n} characters."))
DESCRIBE_SECOND = ((22, None), (1, "A second text of {n} characters."))
