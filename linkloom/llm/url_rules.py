"""URL rules as glob patterns, all simulated at once by a bit-parallel automaton.

A glob is a row of positions, one per byte that it names; `*` lets its position loop on any byte
but a slash, `**` on any byte. All globs lie side by side in words of 64 bits. One step of the
automaton per byte of the URL: shift the state by one, keep the positions whose byte this is, and
keep looping positions that were active already. A batch of URLs steps together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import column

BATCH = 4096


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains, the beginning of a path, and a verdict."""

    verdict: str
    name: str

    @property
    def globs(self) -> list[str]:
        host, slash, path = self.name.partition("/")
        return [f"{prefix}{_literal(host)}{slash}{_literal(path)}**" for prefix in ("", "*.")]


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("*", "\\*")


def _positions(glob: str) -> list[tuple[int | None, str]]:
    """(byte or None for the start, how the position loops) for each position of a glob."""
    out: list[tuple[int | None, str]] = [(None, "")]
    data, i = glob.encode(), 0
    while i < len(data):
        if data[i : i + 2] == b"**":
            out[-1] = (out[-1][0], "any")
            i += 2
        elif data[i : i + 1] == b"*":
            out[-1] = (out[-1][0], out[-1][1] or "no slash")
            i += 1
        else:
            i += data[i : i + 1] == b"\\"
            out.append((data[i], ""))
            i += 1
    return out


class Automaton:
    """Masks of all globs: step, loop and start positions per word, and where each glob ends."""

    def __init__(self, globs: Sequence[str]):
        rows = [_positions(g) for g in globs]
        size = sum(map(len, rows))
        self.words = max(1, -(-size // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.ends: list[int] = []
        at = 0
        for row in rows:
            for offset, (byte, loops) in enumerate(row):
                word, bit = divmod(at + offset, 64)
                mask = np.uint64(1 << bit)
                if byte is None:
                    self.start[word] |= mask
                else:
                    self.step[byte, word] |= mask
                if loops:
                    self.loop[:, word] |= mask
                    if loops == "no slash":
                        self.loop[ord("/"), word] &= ~mask
            at += len(row)
            self.ends.append(at - 1)

    def matches(self, texts: Sequence[bytes]) -> np.ndarray:
        """A row per text, a column per glob: whether the glob fits the whole text."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        state = np.tile(self.start, (len(texts), 1))
        joined = np.frombuffer(b"".join(texts), np.uint8)
        begins = np.concatenate(([0], np.cumsum(lengths)))[:-1][order]
        alive = lengths[order]
        n = len(texts)
        for at in range(int(alive[0]) if len(alive) else 0):
            # Longest first: those with a byte left are the first rows.
            while alive[n - 1] <= at:
                n -= 1
            byte = joined[begins[:n] + at]
            own = state[:n]
            moved = own << np.uint64(1)
            moved[:, 1:] |= own[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.step[byte]) | (own & self.loop[byte])
        out = np.empty((len(texts), len(self.ends)), bool)
        for glob, end in enumerate(self.ends):
            out[order, glob] = state[:, end // 64] >> np.uint64(end % 64) & np.uint64(1)
        return out


def host_and_path(url: Column | str) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z in small letters. Path:
    from there up to `?`, `#` or the end. Both empty for null or a URL without `://`."""
    url = F.col(url) if isinstance(url, str) else url
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substr(url, F.instr(url, "://") + 3), "#", 1))
    rest = F.coalesce(F.substring_index(rest, "?", 1), F.lit(""))
    host = F.substring_index(rest, "/", 1)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, capitals, capitals.lower()), F.substr(rest, F.length(host) + 1)


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """(page_id, url) to (page_id, host, path, rule, verdict), one row per input row.

    A rule fits its host and all subdomains if the path begins with the rule's. The longest rule
    that fits decides, the first in order among equals; with none, `rule` is null and the verdict
    `default`. Null and malformed URLs have an empty host and path and fit no rule.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name))
    globs = [g for r in ranked for g in r.globs]
    owner = np.repeat(np.arange(len(ranked)), [len(r.globs) for r in ranked])
    names, verdicts = [r.name for r in ranked], [r.verdict for r in ranked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(globs)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                texts = [(h + p).encode("utf-8", "surrogatepass") for h, p in zip(column(batch, "host"), column(batch, "path"))]
                hit = automaton.matches(texts)
                first = np.where(hit.any(axis=1), owner[hit.argmax(axis=1)], -1) if len(globs) else np.full(len(texts), -1)
                rule = pa.array([names[i] if i >= 0 else None for i in first], pa.string())
                verdict = pa.array([verdicts[i] if i >= 0 else default for i in first], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, rule, verdict], names=["page_id", "host", "path", "rule", "verdict"]
                )

    host, path = host_and_path("url")
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), host.alias("host"), path.alias("path")).mapInArrow(
        run, "page_id bigint, host string, path string, rule string, verdict string"
    )
