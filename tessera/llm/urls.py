"""URL filters by a bit-parallel wildcard automaton.

All glob rules are packed into the words of one Shift-And register. Every URL of a batch has such a register; one step for each byte column of the batch moves all rules of all URLs at once. In a glob `*` stands for any run of bytes without `/` and `**` for any run at all.

A URL is matched in canonical form: a dot, the host in lower case, and the path. Rules of a host and a path become the glob `*.host/path**` with the star kept out of the path, so that subdomains match and paths can't.

Defined cases: a null url or one without `://` has an empty host and path and is blocked as no absolute address; an empty table gives an empty result; repeated urls are rows of their own; a null page_id stays null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.registry import query

#: Rules of host and path: what a rule says and where it holds. The longest that fits wins.
HOST_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Globs that block a URL that no host rule fits: trackers, sign-in pages, shops' carts, archives and programs.
BLOCK_GLOBS = (
    "*.ads.**",
    "*.adserver.**",
    "*.tracker.**",
    "**/login",
    "**/login/**",
    "**/signup",
    "**/cart/**",
    "**/wp-admin/**",
    "**.exe",
    "**.zip",
    "**.tar.gz",
)


class GlobAutomaton:
    """Shift-And over 64-bit words. Bit k of a rule stands for k of its symbols read; bit 0 is the start."""

    def __init__(self, globs: list[bytes]):
        self.globs = globs
        bits, self.start_bits, self.final_bits = 0, [], []
        step = np.zeros((256, 1 + sum(len(g) + 1 for g in globs)), bool)
        stay = np.zeros_like(step)
        for g in globs:
            self.start_bits.append(bits)
            k = 0
            while k < len(g):
                if g[k : k + 2] == b"**":
                    stay[:, bits] = True
                    k += 2
                elif g[k] == ord("*"):
                    stay[:, bits] = True
                    stay[ord("/"), bits] = False
                    k += 1
                else:
                    bits += 1
                    step[g[k], bits] = True
                    k += 1
            self.final_bits.append(bits)
            bits += 1
        self.words = -(-bits // 64)
        self.step, self.stay = self._pack(step), self._pack(stay)
        self.start = np.zeros(self.words, np.uint64)
        for b in self.start_bits:
            self.start[b // 64] |= np.uint64(1) << np.uint64(b % 64)

    def _pack(self, flags: np.ndarray) -> np.ndarray:
        room = np.zeros((256, self.words * 64), bool)
        room[:, : min(flags.shape[1], room.shape[1])] = flags[:, : room.shape[1]]
        return np.packbits(room.reshape(256, self.words, 64), axis=2, bitorder="little").view(np.uint64).reshape(256, self.words)

    def run(self, texts: list[bytes]) -> np.ndarray:
        """A row for each text and a column for each glob: whether it matches the whole text. Longer texts go first, so that each byte column needs only those that still have one."""
        n = len(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        flat = np.frombuffer(b"".join(texts), np.uint8)
        starts = (np.cumsum(sizes) - sizes)[order]
        active = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), side="left")
        state = np.tile(self.start, (n, 1))
        one, top = np.uint64(1), np.uint64(63)
        for k, m in enumerate(active.tolist()):
            c = flat[starts[:m] + k]
            d = state[:m]
            moved = d << one
            if self.words > 1:
                moved[:, 1:] |= d[:, :-1] >> top
            state[:m] = (moved & self.step[c]) | (d & self.stay[c])
        out = np.empty((n, len(self.globs)), bool)
        for j, b in enumerate(self.final_bits):
            out[order, j] = (state[:, b // 64] >> np.uint64(b % 64)) & one
        return out


def host_and_path():
    """Columns of the host and the path of the column url."""
    rest = F.when(F.col("url").contains("://"), F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, host_rules=HOST_RULES, block_globs=BLOCK_GLOBS) -> DataFrame:
    """page_id, host, path, rule and verdict of every page's url."""
    globs = [f"*.{h}{p}**".encode() for _, h, p in host_rules] + [g.encode() for g in block_globs]
    names = [h + p for _, h, p in host_rules]
    says = [v for v, _, _ in host_rules]
    longest_first = sorted(range(len(names)), key=lambda i: -len(names[i]))

    def run(batches):
        automaton = GlobAutomaton(globs)
        for batch in batches:
            if not len(batch):
                continue
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            hits = automaton.run([f".{h}{p}".encode() for h, p in zip(hosts, paths, strict=True)])
            best = np.full(len(hosts), -1)
            for i in reversed(longest_first):
                best[hits[:, i]] = i
            bad = hits[:, len(names) :].any(axis=1)
            absolute = batch.column(3).to_pylist()
            rules = [names[i] if i >= 0 else None for i in best.tolist()]
            verdicts = [says[i] if i >= 0 else "block" if b or not a else "allow" for i, b, a in zip(best.tolist(), bad.tolist(), absolute, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    host, path = host_and_path()
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    parts = urls.select("page_id", host.alias("host"), path.alias("path"), F.coalesce(F.col("url").contains("://"), F.lit(False)).alias("absolute"))
    return parts.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


_RULE_SQL = "\n".join(f"           WHEN ('.' || host LIKE '%.{h}' AND starts_with(path, '{p}')) THEN '{h}{p}'" for _, h, p in sorted(HOST_RULES, key=lambda r: -len(r[1] + r[2])))
_VERDICT_SQL = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for v, h, p in HOST_RULES)
ORACLE = f"""
WITH rests AS (
    SELECT page_id, coalesce(contains(url, '://'), false) AS absolute,
           CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id, absolute, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests),
ruled AS (
    SELECT *, CASE
{_RULE_SQL}
           ELSE NULL END AS rule
    FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN CASE rule {_VERDICT_SQL} END
            WHEN NOT absolute THEN 'block'
            WHEN regexp_matches('.' || host || path, '^([^/]*\\.(ads|adserver|tracker)\\..*|.*/login|.*/login/.*|.*/signup|.*/cart/.*|.*/wp-admin/.*|.*\\.exe|.*\\.zip|.*\\.tar\\.gz)$', 's') THEN 'block'
            ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op3_url_filters", ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
