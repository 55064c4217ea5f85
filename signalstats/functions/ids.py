"""Short text ids: 128-bit hash, base64url without padding, 22 characters.

``md5`` is the default: it is a built-in, runs in the JVM and any SQL engine can
reproduce it. ``murmur3`` (x64, 128 bit, seed 0) gives ids that compare equal to
those of existing aggregate topics; Spark has no built-in for it, so it runs as
an Arrow UDF. Either way ids are made from key columns after the aggregation,
once per output row and not once per event.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from signalstats.functions.enums import enum_number
from signalstats.model import DIMENSIONS, MESSAGES


def _as_bytes(payload: Column | str) -> Column:
    return (F.col(payload) if isinstance(payload, str) else payload).cast("binary")


def generate_id(payload: Column | str, algorithm: str = "md5") -> Column:
    """Id of a STRING or BINARY column."""
    data = _as_bytes(payload)
    if algorithm == "md5":
        return F.translate(F.rtrim(F.base64(F.unhex(F.md5(data))), F.lit("=")), "+/", "-_")
    if algorithm == "murmur3":
        return _murmur3_id()(data)
    raise ValueError(f"unknown id algorithm: {algorithm}")


def dimensions_text(dims: dict[str, Column]) -> Column:
    """``name=value`` pairs of the set dimensions, in order.

    Backslash and ``|`` in values are escaped, so that different dimensions never
    give the same text, and an unset dimension differs from an empty one.
    """

    def pair(name: str, value: Column) -> Column:
        text = F.replace(F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        return F.concat(F.lit(f"{name}="), text)

    return F.concat_ws("|", *[pair(name, value) for name, value in dims.items()])


def dimensions_bytes(dims: dict[str, Column]) -> Column:
    """Protobuf encoding of the ``Dimensions`` message, built from expressions.

    Enum numbers are below 128, so each takes one byte; only the route is of
    variable length.
    """
    parts = []
    for name in DIMENSIONS:
        number, kind = MESSAGES["Dimensions"][name]
        value = dims.get(name)
        if value is None:
            continue
        if kind == "string":
            data = F.encode(value, "UTF-8")
            body = F.concat(F.unhex(F.lit(f"{number << 3 | 2:02x}")), _varint(F.octet_length(data)), data)
        else:
            tag = F.lit(f"{number << 3:02x}")
            body = F.unhex(F.concat(tag, F.lpad(F.hex(enum_number(kind, value).cast("long")), 2, "0")))
        parts.append(F.coalesce(body, F.unhex(F.lit(""))))
    return F.concat(*parts)


def _varint(n: Column) -> Column:
    """Base-128 bytes of an INT, low group first."""

    def byte(group: int) -> Column:
        bits = F.shiftrightunsigned(n, 7 * group)
        low = bits.bitwiseAND(F.lit(0x7F))
        more = F.when(bits >= 128, low + 128).otherwise(low)
        return F.when((bits > 0) | F.lit(group == 0), F.lpad(F.hex(more.cast("long")), 2, "0")).otherwise(F.lit(""))

    return F.unhex(F.concat(*[byte(group) for group in range(5)]))


def dimension_hash(dims: dict[str, Column], algorithm: str = "md5") -> Column:
    """Id of a set of dimensions (murmur3: of their protobuf encoding)."""
    payload = dimensions_bytes(dims) if algorithm == "murmur3" else dimensions_text(dims)
    return generate_id(payload, algorithm)


def grouping_key(group: Column, name: Column, dim_hash: Column, algorithm: str = "md5") -> Column:
    """Id over the id of ``group.name.`` followed by the dimension hash."""
    prefix = generate_id(F.concat(group, F.lit("."), name, F.lit(".")), algorithm)
    return generate_id(F.concat(prefix, dim_hash), algorithm)


def series_id(*key: Column, algorithm: str = "md5") -> Column:
    """Id of a whole aggregation key."""
    named = {str(i): column for i, column in enumerate(key)}
    return generate_id(dimensions_text(named), algorithm)


def _murmur3_id():
    @F.arrow_udf("string")
    def murmur3_id(payload: pa.Array) -> pa.Array:
        digests = murmur3_128(payload)
        # 16 bytes are 22 base64url characters: 21 of six bits and one of two.
        bits = np.unpackbits(digests, axis=1)
        groups = np.pad(bits, ((0, 0), (0, 4))).reshape(len(digests), 22, 6)
        letters = _BASE64[groups @ (1 << np.arange(5, -1, -1))]
        offsets = np.arange(0, 22 * len(digests) + 1, 22, dtype=np.int32)
        texts = pa.StringArray.from_buffers(len(digests), pa.py_buffer(offsets), pa.py_buffer(letters.tobytes()))
        return pc.if_else(payload.is_valid(), texts, pa.scalar(None, pa.string()))

    return murmur3_id


_BASE64 = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", np.uint8)


def murmur3_128(payloads: pa.Array, seed: int = 0) -> np.ndarray:
    """MurmurHash3 x64 128 (public domain algorithm) of all byte strings, 16 bytes each.

    Works on the n-th 16-byte block of every string at once; NULL counts as empty.
    """
    lengths = pc.fill_null(pc.binary_length(payloads), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    _, where, data = payloads.buffers()
    offsets = np.frombuffer(where, np.int32)[payloads.offset : payloads.offset + len(payloads)].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    c1, c2 = np.uint64(0x87C37B91114253D5), np.uint64(0x4CF5AD432745937F)

    def rotl(x: np.ndarray, r: int) -> np.ndarray:
        return x << np.uint64(r) | x >> np.uint64(64 - r)

    def mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ x >> np.uint64(33)

    def block(rows: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Two words from position ``at`` on, zeros beyond the end of the string."""
        place = at + np.arange(16)
        inside = place < lengths[rows, None]
        read = np.where(inside, offsets[rows, None] + place, 0)
        taken = np.where(inside, raw[read], 0) if len(raw) else np.zeros(inside.shape)
        words = np.ascontiguousarray(taken, np.uint8).view("<u8")
        return words[:, 0], words[:, 1]

    h1 = np.full(len(lengths), seed, np.uint64)
    h2 = h1.copy()
    order = np.argsort(-lengths, kind="stable")
    whole = lengths[order] // 16
    for at in range(int(whole[0]) if len(whole) else 0):
        rows = order[: np.searchsorted(-whole, -at)]
        k1, k2 = block(rows, 16 * at)
        a, b = h1[rows], h2[rows]
        a = (rotl(a ^ rotl(k1 * c1, 31) * c2, 27) + b) * np.uint64(5) + np.uint64(0x52DCE729)
        b = (rotl(b ^ rotl(k2 * c2, 33) * c1, 31) + a) * np.uint64(5) + np.uint64(0x38495AB5)
        h1[rows], h2[rows] = a, b
    # Zero padding contributes nothing, so the tails can be read as two words.
    for tail in np.unique(lengths // 16).tolist():
        rows = np.flatnonzero(lengths // 16 == tail)
        k1, k2 = block(rows, 16 * tail)
        h1[rows] ^= rotl(k1 * c1, 31) * c2
        h2[rows] ^= rotl(k2 * c2, 33) * c1
    h1, h2 = h1 ^ lengths.view(np.uint64), h2 ^ lengths.view(np.uint64)
    h1 = h1 + h2
    h2 = h2 + h1
    h1, h2 = mix(h1), mix(h2)
    h1 = h1 + h2
    return np.stack([h1, h2 + h1], axis=1).astype("<u8").view(np.uint8)
