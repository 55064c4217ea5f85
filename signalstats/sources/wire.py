"""Messages of the data model by the protobuf runtime, an Arrow batch at a time.

For sessions without Spark's protobuf package. What the messages look like follows from
the tables of the data model; the same description serves the JVM functions.
"""

from __future__ import annotations

from functools import cache

import pyarrow as pa

from signalstats.model import ENUMS, MESSAGES

try:
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    from google.protobuf.message import DecodeError
except ImportError:  # pragma: no cover
    descriptor_pb2 = None

PACKAGE = "signalstats"
_UINT32_MAX, _UINT64 = 2**32 - 1, 2**64
_TYPES = {"uint64": pa.int64(), "uint32": pa.int64(), "double": pa.float64(), "float": pa.float32()}
_NUMBERS = {enum: {text: number for number, text in names.items()} for enum, names in ENUMS.items()}


@cache
def _file():
    """File descriptor made from the tables of the data model."""
    file = descriptor_pb2.FileDescriptorProto(name=f"{PACKAGE}.proto", package=PACKAGE, syntax="proto2")
    for enum, names in ENUMS.items():
        # Value names are scoped by the file, and two enums may share one;
        # wrapping each enum in a message of its own keeps them apart.
        holder = file.message_type.add(name=f"{enum}Values").enum_type.add(name=enum)
        for number, name in names.items():
            holder.value.add(name=name, number=number)
    field = descriptor_pb2.FieldDescriptorProto
    for message, fields in MESSAGES.items():
        described = file.message_type.add(name=message)
        for name, (number, kind) in fields.items():
            added = described.field.add(name=name, number=number, label=field.LABEL_OPTIONAL)
            if kind in MESSAGES:
                added.type, added.type_name = field.TYPE_MESSAGE, f".{PACKAGE}.{kind}"
            elif kind in ENUMS:
                added.type, added.type_name = field.TYPE_ENUM, f".{PACKAGE}.{kind}Values.{kind}"
            else:
                added.type = getattr(field, f"TYPE_{kind.upper()}")
    return file


def descriptor_set() -> bytes:
    """Binary descriptor set, as ``from_protobuf`` and ``to_protobuf`` take it."""
    return descriptor_pb2.FileDescriptorSet(file=[_file()]).SerializeToString()


@cache
def _message_class(message: str):
    if descriptor_pb2 is None:
        raise ImportError("protobuf payloads need spark-protobuf in the session or protobuf for Python on the executors")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(_file())
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{PACKAGE}.{message}"))


def _texts(messages: list, known: list[bool], name: str, bad: list[bool]) -> list[str | None]:
    texts = []
    for i, (message, there) in enumerate(zip(messages, known, strict=True)):
        try:
            texts.append(getattr(message, name) if there else None)
        except UnicodeDecodeError:
            bad[i] = True
            texts.append(None)
    return texts


def _column(messages: list, name: str, kind: str, bad: list[bool]) -> pa.Array:
    """One field of all messages: enums by name, 64-bit numbers as BIGINT."""
    known = [m.HasField(name) for m in messages]
    if kind in MESSAGES:
        return _struct([getattr(m, name) for m in messages], kind, [not there for there in known], bad)
    if kind == "string":
        return pa.array(_texts(messages, known, name, bad), pa.string())
    values = [getattr(m, name) if there else None for m, there in zip(messages, known, strict=True)]
    if kind in ENUMS:
        return pa.array(map(ENUMS[kind].get, values), pa.string())
    if kind == "uint64":
        values = [v - _UINT64 if v is not None and v >= _UINT64 // 2 else v for v in values]
    return pa.array(values, _TYPES[kind])


def _struct(messages: list, message: str, missing: list[bool], bad: list[bool]) -> pa.StructArray:
    columns = [_column(messages, name, kind, bad) for name, (_, kind) in MESSAGES[message].items()]
    return pa.StructArray.from_arrays(columns, list(MESSAGES[message]), mask=pa.array(missing, pa.bool_()))


def read(payloads: pa.Array, message: str) -> pa.StructArray:
    """Messages of BINARY payloads. Unset fields and unknown enum numbers are NULL, a
    payload that is NULL or malformed is NULL as a whole. Fields that the message does
    not have are skipped."""
    new = _message_class(message)
    nothing, messages, bad = new(), [], []
    for payload in payloads.to_pylist():
        try:
            messages.append(nothing if payload is None else new.FromString(payload))
            bad.append(payload is None)
        except DecodeError:
            messages.append(nothing)
            bad.append(True)
    built = _struct(messages, message, [False] * len(bad), bad)
    return pa.StructArray.from_arrays(built.flatten(), list(MESSAGES[message]), mask=pa.array(bad, pa.bool_()))


def _fill(messages: list, rows: pa.StructArray, message: str) -> None:
    """Set the fields of all messages, one field after another."""
    columns = dict(zip((f.name for f in rows.type), rows.flatten(), strict=True))
    for name, (_, kind) in MESSAGES[message].items():
        column = columns.get(name)
        if column is None or pa.types.is_null(column.type):
            continue
        if kind in MESSAGES:
            known = column.filter(column.is_valid())
            inner = [getattr(m, name) for m, there in zip(messages, column.is_valid().to_pylist(), strict=True) if there]
            for target in inner:
                target.SetInParent()
            _fill(inner, known, kind)
            continue
        for target, value in zip(messages, column.to_pylist(), strict=True):
            if value is None:
                continue
            if kind in ENUMS:
                if value not in _NUMBERS[kind]:
                    raise ValueError(f"a {name} is not among {sorted(_NUMBERS[kind])}")
                value = _NUMBERS[kind][value]
            elif kind == "uint64":
                value %= _UINT64
            elif kind == "uint32":
                # The field holds no more; a larger number is sent as the largest.
                value = min(value, _UINT32_MAX)
            setattr(target, name, value)


def write(rows: pa.StructArray, message: str) -> pa.Array:
    """BINARY payloads of messages; NULL fields stay unset, NULL rows are NULL."""
    new, there = _message_class(message), rows.is_valid()
    messages = [new() for _ in range(len(rows) - rows.null_count)]
    _fill(messages, rows.filter(there), message)
    payloads = iter([m.SerializeToString() for m in messages])
    return pa.array([next(payloads) if known else None for known in there.to_pylist()], pa.binary())
