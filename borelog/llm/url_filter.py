"""URL filters by a bit-parallel automaton of all rules at once.

A rule is a glob over ``host`` + ``path``. It takes one bit per character and one for its start; the bits of all rules stand
side by side in 64-bit words. Reading a byte shifts every bit that the byte allows by one (Shift-And) and leaves those
bits standing that wait in a wildcard. Many URLs are read side by side, a byte of each at a time.
"""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

ONE, TOP = np.uint64(1), np.uint64(63)
STRAGGLERS = 8
STATE_WORDS = 1 << 18


@dataclass(frozen=True)
class HostRule:
    """Fits a host, its subdomains and every path that starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class GlobRule:
    """``*`` stands for any run without a slash, ``**`` for any run, ``?`` for a character that is no slash."""

    glob: str
    verdict: str


# The rules of hosts, and the globs for URLs that no such rule fits.
HOST_RULES = (
    HostRule("org", "/", "allow"),
    HostRule("example.org", "/es/", "block"),
    HostRule("example.org", "/en/1", "block"),
    HostRule("com", "/fr/", "allow"),
    HostRule("com", "/de/", "block"),
)
GLOB_RULES = (GlobRule("*casino*/**", "block"), GlobRule("*cheap-pills*/**", "block"), GlobRule("*free-bets*/**", "block"))

ANY, NO_SLASH = frozenset(range(256)), frozenset(range(256)) - {ord("/")}
CONTINUES = frozenset(range(0x80, 0xC0))


def _steps(glob: str) -> list[tuple[frozenset, frozenset]]:
    """For the start and each character of a glob: the bytes that lead there, and those on which it stands still."""
    steps, at = [(frozenset(), frozenset())], 0
    while at < len(glob):
        if glob[at] == "*":
            several = glob[at : at + 2] == "**"
            enters, stays = steps[-1]
            steps[-1] = enters, stays | (ANY if several else NO_SLASH)
            at += 1 + several
            continue
        if glob[at] == "?":
            steps.append((NO_SLASH - CONTINUES, CONTINUES))
        else:
            steps += [(frozenset([byte]), frozenset()) for byte in glob[at].encode()]
        at += 1
    return steps


def _literal(text: str) -> list[tuple[frozenset, frozenset]]:
    return [(frozenset([byte]), frozenset()) for byte in text.encode()]


def host_rule_steps(rule: HostRule) -> list[list]:
    """The two globs of a host rule, ``host/path**`` and ``*.host/path**``; its own characters are no wildcards."""
    tail = _literal(rule.name)
    tail = [*tail[:-1], (tail[-1][0], ANY)] if tail else []
    whole = [(frozenset(), frozenset() if tail else ANY), *tail]
    below = [(frozenset(), NO_SLASH), *_literal("."), *tail]
    return [whole, below]


class UrlAutomaton:
    """All rules in one state of some words. Of several rules that fit, the one given first is reported."""

    def __init__(self, patterns: Sequence[tuple[list, int]]):
        """``patterns`` are (steps, rule number) in order of preference."""
        bits = sum(len(steps) for steps, _ in patterns)
        self.words = max(1, -(-bits // 64))
        self.enter = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.ends, at = [], 0
        for steps, rule in patterns:
            self.start[at >> 6] |= ONE << np.uint64(at & 63)
            for enters, stays in steps:
                bit = ONE << np.uint64(at & 63)
                self.enter[list(enters), at >> 6] |= bit
                self.stay[list(stays), at >> 6] |= bit
                at += 1
            self.ends.append(((at - 1) >> 6, ONE << np.uint64((at - 1) & 63), rule))
        whole = lambda table: [int.from_bytes(row.astype("<u8").tobytes(), "little") for row in table]
        self.enter_whole, self.stay_whole = whole(self.enter), whole(self.stay)

    def rules(self, urls: Sequence[bytes]) -> np.ndarray:
        """Number of the first rule that fits each URL, -1 if none does."""
        found, step = np.full(len(urls), -1), max(1, STATE_WORDS // self.words)
        for start in range(0, len(urls), step):
            found[start : start + step] = self._block(urls[start : start + step])
        return found

    def _block(self, urls: Sequence[bytes]) -> np.ndarray:
        lengths = np.array([len(u) for u in urls])
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(urls), np.uint8)
        begin = (np.cumsum(lengths) - lengths)[order]
        lengths = lengths[order]
        state = np.repeat(self.start[None], len(urls), axis=0)
        at, active = 0, int(np.count_nonzero(lengths))
        while active > STRAGGLERS:  # the longer URLs come first; those at their end drop out behind
            byte, now = data[begin[:active] + at], state[:active]
            moved = now << ONE
            moved[:, 1:] |= now[:, :-1] >> TOP
            state[:active] = (moved & self.enter[byte]) | (now & self.stay[byte])
            at += 1
            active = int(np.searchsorted(-lengths[:active], -at))
        for row in range(active):  # a few URLs may be far longer than the rest
            whole = int.from_bytes(state[row].astype("<u8").tobytes(), "little")
            for byte in urls[order[row]][at:]:
                whole = ((whole << 1) & self.enter_whole[byte]) | (whole & self.stay_whole[byte])
                if not whole:
                    break
            state[row] = np.frombuffer(whole.to_bytes(self.words * 8, "little"), "<u8")
        found = np.full(len(urls), -1)
        for word, bit, rule in reversed(self.ends):
            found[order[(state[:, word] & bit) != 0]] = rule
        return found


def url_parts(url: str = "url") -> tuple[Column, Column]:
    """Host, with A-Z lowered, and path of a URL; both empty without ``://``."""
    url, pattern = F.coalesce(F.col(url), F.lit("")), "://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, pattern, 2)


def filter_urls(
    pages: DataFrame,
    host_rules: Sequence[HostRule] = HOST_RULES,
    glob_rules: Sequence[GlobRule] = GLOB_RULES,
    default: str = "allow",
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Judge each URL: ``key``, host, path, rule, glob and verdict, a row per row of ``pages``.

    The longest host rule that fits decides (of equally long ones the one given first), ``rule`` is its host and path.
    Without one the longest glob that fits decides and is named in ``glob``; without either the verdict is ``default``, as
    for a URL that is NULL, empty or has no ``://``. Repeated rows and NULL keys are kept, an empty table gives an empty
    result, other columns are ignored. No shuffle; the rules travel to the tasks, a URL passes all of them in one reading.
    """
    ranked = sorted(range(len(host_rules)), key=lambda i: -len(host_rules[i].name))
    patterns = [(steps, i) for i in ranked for steps in host_rule_steps(host_rules[i])]
    ranked = sorted(range(len(glob_rules)), key=lambda i: -len(glob_rules[i].glob))
    patterns += [(_steps(glob_rules[i].glob), len(host_rules) + i) for i in ranked]
    automaton = UrlAutomaton(patterns)
    names = np.array([*[r.name for r in host_rules], *[None] * len(glob_rules), None], object)
    globs = np.array([*[None] * len(host_rules), *[r.glob for r in glob_rules], None], object)
    verdicts = np.array([*[r.verdict for r in (*host_rules, *glob_rules)], default], object)

    def judge(batches):
        for batch in batches:
            # An empty host is that of no URL: no rule, not even ``**``, fits it.
            found = automaton.rules([(h + p).encode() for h, p in zip(batch.host, batch.path)])
            found[(batch.host == "").to_numpy()] = -1
            yield pd.DataFrame({
                "key": batch.key.array, "host": batch.host.array, "path": batch.path.array,
                "rule": names[found], "glob": globs[found], "verdict": verdicts[found],
            })

    host, path = url_parts(url)
    rows = pages.select(F.col(key).cast("long").alias("key"), host.alias("host"), path.alias("path"))
    judged = rows.mapInPandas(judge, "key long, host string, path string, rule string, glob string, verdict string")
    return judged.withColumnRenamed("key", key)
