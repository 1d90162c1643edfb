"""Secret scans: Aho-Corasick prefilter, anchored patterns near its hits only, checksums where the format has one.

The keywords of all kinds are found in one pass over the lower-cased text. At each hit the kind's pattern is tried where
the keyword starts, nowhere else. Long runs of hexadecimal digits have no keyword: they are found by and-ing shifted
masks of a whole batch of texts. GitHub and npm tokens carry a CRC-32 of their own, IBANs a remainder, JSON web tokens a
header: those that fail are dropped.

Defined results. Null and empty texts: no spans. Repeated rows: one result row each. Spans of different kinds may
overlap; those of one kind don't (leftmost first). Ties in start go by the order of KINDS. Very long texts are scanned
in whole, in time that grows with their length only: no stretch that failed a kind is tried again from a later start in
it. Offsets are code points, ends exclusive. Other columns are kept, whatever their names: the added one gets a number if
its name is taken (secrets_1).
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import bounded_batches, by_name, chunks, free_name, table

#: In the order of the spans. The first three are the base kinds.
KINDS = ["assign", "access", "hex", "github", "npm", "iban", "jwt", "pem", "slack", "stripe", "google"]
HEX_LEAST = 16

#: kind: (keywords, lower-case; pattern from where the keyword starts)
PATTERNS = {
    "assign": (["password", "passwd", "secret", "token", "apikey", "api_key"], r"""(?a:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""),
    "access": (["akia"], r"AKIA[A-Z0-9]+"),
    "github": (["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": (["npm_"], r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "iban": (["iban"], r"(?a:(?i:iban)\x20*[:=]?\x20*([A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})(?![A-Za-z0-9]))"),
    "jwt": (["eyj"], r"(eyJ[A-Za-z0-9_-]++)\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]+"),
    "pem": (["-----begin "], r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    "slack": (["xoxb-", "xoxp-"], r"xox[bp]-[A-Za-z0-9-]{10,}"),
    "stripe": (["sk_live_"], r"sk_live_[A-Za-z0-9]{16,}"),
    "google": (["aiza"], r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"),
}
#: Of kinds whose pattern begins with an open run of signs: that run. What follows it decides for every start in it, so
#: where one start fails, all later ones in the run do.
RUNS = {"jwt": r"eyJ[A-Za-z0-9_-]*+"}
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc62(token: str) -> bool:
    """The last 6 of 36 characters are the CRC-32 of the first 30 in base 62."""
    body, n, out = token[-36:-6], zlib.crc32(token[-36:-6].encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = _BASE62[r] + out
    return bool(body) and out == token[-6:]


def _iban(value: str) -> bool:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _jwt(head: str) -> bool:
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4))), dict)
    except (ValueError, binascii.Error):
        return False


CHECKS = {
    "assign": lambda m: len(m[1]) >= 12,
    "access": lambda m: len(m[0]) >= 18,
    "github": lambda m: _crc62(m[0]),
    "npm": lambda m: _crc62(m[0]),
    "iban": lambda m: _iban(m[1]),
    "jwt": lambda m: _jwt(m[1]),
}


class Scanner:
    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for kind, (keywords, _) in PATTERNS.items():
            for k in keywords:
                self.automaton.add_word(k, (kind, len(k)))
        self.automaton.make_automaton()
        self.patterns = {kind: re.compile(p) for kind, (_, p) in PATTERNS.items()}
        self.runs = {kind: re.compile(p) for kind, p in RUNS.items()}
        self.hex = np.zeros(256, dtype=bool)
        self.hex[list(b"0123456789abcdef")] = True

    def keyed(self, text: str) -> list[tuple[str, int, int]]:
        lower = text.encode().lower().decode()  # A-Z only: as many code points
        hits = [(end + 1 - n, kind) for end, (kind, n) in self.automaton.iter(lower)]
        spans, free = [], {}
        for start, kind in sorted(hits):
            if start < free.get(kind, 0):
                continue
            if m := self.patterns[kind].match(text, start):
                free[kind] = m.end()
                if kind not in CHECKS or CHECKS[kind](m):
                    spans.append((kind, start, m.end()))
                elif kind in self.runs:
                    free[kind] = m.end(1)  # the next run may begin a good one
            elif kind in self.runs and (m := self.runs[kind].match(text, start)):
                free[kind] = m.end()
        return spans

    def hexes(self, texts: list[bytes]) -> dict[int, list[tuple[int, int]]]:
        """Of each text with runs of HEX_LEAST hexadecimal digits or more: their bounds in code points."""
        data = b"\n".join(texts)
        run = self.hex[np.frombuffer(data, dtype=np.uint8)]
        long, width = run, 1
        while width < HEX_LEAST:
            step = min(width, HEX_LEAST - width)
            if len(long) <= step:
                return {}
            long, width = long[:-step] & long[step:], width + step
        found: dict[int, list[tuple[int, int]]] = {}
        if long.any():
            starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
            places = np.flatnonzero(long)
            first = places[np.concatenate(([True], np.diff(places) > 1))]
            last = places[np.concatenate((np.diff(places) > 1, [True]))] + HEX_LEAST
            for a, z in zip(first.tolist(), last.tolist(), strict=True):
                k = int(np.searchsorted(starts, a, side="right")) - 1
                a0 = len(data[int(starts[k]) : a].decode())
                found.setdefault(k, []).append((a0, a0 + z - a))
        return found


_SCANNER: list[Scanner] = []


def scan_texts(texts: list[str]) -> list[list[dict]]:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    scanner = _SCANNER[0]
    hexes = scanner.hexes([t.encode() for t in texts])
    out = []
    for k, text in enumerate(texts):
        spans = scanner.keyed(text) + [("hex", a, z) for a, z in hexes.get(k, ())]
        out.append([{"kind": kind, "start": a, "stop": z} for kind, a, z in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))])
    return out


def secret_spans(text: Column) -> Column:
    """array<struct<kind,start,stop>> of a string column."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def scan(column: pa.Array) -> pa.Array:
        out = []
        for start, stop in chunks(column):
            out += scan_texts([t or "" for t in column.slice(start, stop - start).to_pylist()])
        return pa.array(out, type=kind)

    return F.arrow_udf(scan, "array<struct<kind:string,start:bigint,stop:bigint>>")(text)


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """docs with an array of spans (kind, start, stop), in a column `into` or the first free of `into`_1, ..."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(free_name(docs, into), secret_spans(by_name(docs, text)))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"].isin(KINDS[:3]))
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("secrets")).alias("spans"))
