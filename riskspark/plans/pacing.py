"""The pace of calls: a minimum gap for one caller, or one total rate that callers share while they run."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Sequence

#: Seconds of a round of callers that share a rate; a barrier takes about one.
ROUND = 2.0


class Pace:
    """Calls at least ``gap`` seconds apart, whatever a call itself takes."""

    def __init__(self, gap: float):
        self.gap, self.next = gap, 0.0

    def wait(self, backlog: int = 1) -> None:
        now = time.monotonic()
        if now < self.next:
            time.sleep(self.next - now)
        self.next = max(now, self.next) + self.gap

    def end(self) -> None:
        """Nothing to give away: the gap is the caller's own."""


def shares(wants: Sequence[int], budget: int, turn: int = 0) -> list[int]:
    """The most even split of ``budget`` calls among callers that want at most so many each.

    What a caller does not want goes to the others. Ties are broken by ``turn``, so a rest goes round.
    """
    out, left = [0] * len(wants), max(0, budget)
    order = sorted(range(len(wants)), key=lambda i: (wants[i], (i + turn) % len(wants)))
    for place, caller in enumerate(order):
        out[caller] = min(wants[caller], -(-left // (len(order) - place)))
        left -= out[caller]
    return out


class SharedPace:
    """A total rate for callers that split the calls of each round of ``period`` seconds.

    ``exchange`` is a barrier that gives every caller the messages of all, in the same order. It takes its time, so the
    calls of the round after are split while those of a round are made. A caller asks for what it can use: the calls it
    has waiting, and no more than fit in a round at the time its calls take; until it has ended that is at least one. All
    callers compute the same split, so no one is in charge. A round whose exchange took longer than ``period`` is
    followed by one of that length, up to twice the period, with its calls spread over it: the rate is never exceeded.
    """

    def __init__(self, rate: float, exchange: Callable[[str], Sequence[str]], me: int, period: float = ROUND):
        self.rate, self.exchange, self.me, self.period = rate, exchange, me, period
        self.granted = self.used = self.turn = 0
        self.began, self.span, self.spread, self.lasted, self.rest = None, period, period, period, 0.0
        self.called, self.took = None, 0.0
        self.coming: tuple[threading.Thread, list] | None = None

    def wait(self, backlog: int = 1) -> None:
        """Returns when the next call may be made; ``backlog`` is the number of calls known to be waiting."""
        now = time.monotonic()
        if self.called is not None:
            self.took = now - self.called if not self.took else 0.7 * self.took + 0.3 * (now - self.called)
        while self.used >= self.granted or self._over(now):
            self._round(lambda: self._want(backlog))
            now = self.began
        due = self.began + self.spread * self.used / self.granted
        time.sleep(max(0.0, due - time.monotonic()))
        self.used += 1
        self.called = time.monotonic()

    def end(self) -> None:
        """Goes on meeting the others, wanting nothing, until no one wants anything."""
        self._round(lambda: 0)
        while self.coming:
            self._round(lambda: 0)

    def _over(self, now: float) -> bool:
        """The round has ended and the next one is there: calls not made in time lapse, so that the others need not wait."""
        return now >= self.began + self.span and self.coming is not None and not self.coming[0].is_alive()

    def _want(self, backlog: int) -> int:
        fits = max(1, int(self.period / self.took)) if self.took else backlog
        return max(1, min(backlog - self.granted, fits))

    def _round(self, want: Callable[[], int]) -> None:
        """Begin the round whose calls have been split, and ask for calls of the one after it."""
        if self.coming is None:
            self._ask(want())
        asking, answer = self.coming
        asking.join()
        if isinstance(answer[0], BaseException):
            raise answer[0]
        if self.began is not None:
            time.sleep(max(0.0, self.began + self.span - time.monotonic()))
        now = time.monotonic()
        self.lasted = self.period if self.began is None else now - self.began
        told = [json.loads(m) for m in answer[0]]
        wants = [w for w, _ in told]
        self.began, self.span = now, min(max(told[0][1], self.period), 2 * self.period)
        whole = self.rate * self.span + self.rest
        self.rest = whole - int(whole)
        split = shares(wants, int(whole), self.turn)
        self.granted, self.used = split[self.me], 0
        self.spread = self.span * sum(split) / max(1, int(whole))  # fewer calls than could be made are over sooner
        self.turn += 1
        self.coming = None
        if any(wants):
            self._ask(want())

    def _ask(self, want: int) -> None:
        message, answer = json.dumps([want, self.lasted]), []

        def ask() -> None:
            try:
                answer.append(self.exchange(message))
            except BaseException as failure:  # noqa: BLE001 - raised again by the caller that waits for it
                answer.append(failure)

        asking = threading.Thread(target=ask, daemon=True)
        asking.start()
        self.coming = asking, answer


def barrier_pace(rate: float, period: float = ROUND) -> SharedPace:
    """The pace of one task of a barrier stage."""
    from pyspark import BarrierTaskContext

    context = BarrierTaskContext.get()
    return SharedPace(rate, context.allGather, context.partitionId(), period)
