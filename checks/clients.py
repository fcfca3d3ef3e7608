"""A stand-in model whose answer depends on the text alone.

It stands for every way a model can answer or fail; ``oracle.py`` states the
same rule in SQL.
"""

import threading

# The answer by length of the text modulo 16; any other
# remainder gets a full answer.
REFUSED, BUSY_TWICE, BUSY, DOWN_ONCE, GARBLED = 0, 1, 2, 3, 4
NULL_REPLY, ARRAY_REPLY, EMPTY_REPLY, EXPLICIT_NULL, BROKEN = 5, 6, 7, 8, 9


def full_answer(text: str) -> str:
    kind = "memo" if len(text) < 1000 else "letter" if len(text) < 2500 else "contract"
    if " the " in text:
        place = "EN"
    elif " der " in text:
        place = "DE"
    elif " les " in text:
        place = "FR"
    else:
        place = "ES"
    return f'{{"type":"{kind}","jurisdiction":"{place}"}}'


class RuleClient:
    """Counts the failures it still owes a text per thread: one call's attempts
    are made one after the other on one thread."""

    def __init__(self):
        self.local = threading.local()

    def __call__(self, payload: dict) -> tuple[int, str]:
        (text,) = payload.values()
        rule = len(text) % 16
        failed = getattr(self.local, "failed", 0)
        if rule == REFUSED:
            return 500, "refused"
        if rule == BUSY or (rule == BUSY_TWICE and failed < 2):
            self.local.failed = failed + 1 if rule == BUSY_TWICE else 0
            return 429, "busy"
        if rule == DOWN_ONCE and failed < 1:
            self.local.failed = 1
            raise ConnectionError("no answer")
        self.local.failed = 0
        if rule == BROKEN:
            raise ValueError("broken client")
        fixed = {
            GARBLED: '{"type"',
            NULL_REPLY: "null",
            ARRAY_REPLY: "[1]",
            EMPTY_REPLY: "{}",
            EXPLICIT_NULL: '{"type": null, "jurisdiction": "XX"}',
        }
        return 200, fixed.get(rule) or full_answer(text)


class OneShotClient(RuleClient):
    """Owes nothing from one call to the next: for runs that ask only once."""

    def __call__(self, payload: dict) -> tuple[int, str]:
        self.local.failed = 0
        return super().__call__(payload)


def no_wait(seconds: float) -> None:
    """A sleep that only pretends."""
