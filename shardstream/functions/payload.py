"""Record payloads: bytes, text, and the typed attributes of change records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

CHANGE_RECORD = "eventName string, dynamodb struct<NewImage: map<string, struct<N: string, S: string>>>"


def to_text(data: Column | str) -> Column:
    return F.decode(data, "UTF-8")


def to_bytes(text: Column | str) -> Column:
    return F.encode(text, "UTF-8")


def change_record(data: Column | str) -> Column:
    """The change record in a payload as a struct; null where the payload is not JSON."""
    return F.from_json(to_text(data), CHANGE_RECORD)


def image_column(change: Column, attribute: str, kind: str) -> Column:
    """One attribute of the new image. Kind ``N`` is a number held as a string, ``S`` a string."""
    if kind not in ("N", "S"):
        raise ValueError(f"attribute kind must be N or S, not {kind!r}")
    return change["dynamodb"]["NewImage"][attribute][kind]


def image_columns(change: Column, attributes: Mapping[str, tuple[str, str, str]]) -> list[Column]:
    """Columns from ``{column: (attribute, kind, type)}``."""
    return [
        image_column(change, attribute, kind).cast(type_).alias(column)
        for column, (attribute, kind, type_) in attributes.items()
    ]


# The kinds of attribute values.
KINDS = ("N", "S", "B", "BOOL", "NULL", "NS", "SS", "BS", "L", "M")

# An attribute of an image, or the way to a value in it: names of map entries and places in lists.
Attribute = str | Sequence[str | int]


def change_variant(data: Column | str) -> Column:
    """The change record in a payload with all its nested values; null where the payload is not JSON."""
    return F.try_parse_json(to_text(data))


def image_value(change: Column, attribute: Attribute, kind: str, type_: str, image: str = "NewImage") -> Column:
    """One value of an image of ``change_variant``, of any kind; null where it is absent, of another kind, or no ``type_``.

    ``N`` and ``NS`` are numbers held as strings, ``B`` and ``BS`` bytes in base 64, ``BOOL`` and ``NULL`` booleans. ``L`` and ``M``
    are lists and maps whose elements name their kinds: ``type_`` is ``variant``, or says which elements are wanted, as in
    ``array<struct<S: string>>``. ``attribute`` is a name, or a sequence that leads into maps by name and into lists by
    place: ``("address", "lines", 0)``.
    """
    if kind not in KINDS:
        raise ValueError(f"attribute kind must be one of {', '.join(KINDS)}, not {kind!r}")
    first, *inside = [attribute] if isinstance(attribute, str) else attribute
    steps = [f".L[{s}]" if isinstance(s, int) else f".M{_entry(s)}" for s in inside]
    path = "".join(["$.dynamodb", _entry(image), _entry(first), *steps, f".{kind}"])

    def get(as_type: str) -> Column:
        return F.try_variant_get(change, path, as_type)

    if kind in ("N", "S"):
        return get("string").try_cast(type_)
    if kind == "B":
        return F.try_to_binary(get("string"), F.lit("base64"))
    if kind in ("NS", "SS"):
        return get("array<string>").try_cast(type_)
    if kind == "BS":
        return F.transform(get("array<string>"), lambda b: F.try_to_binary(b, F.lit("base64")))
    return get(type_)


def _entry(name: str) -> str:
    quote = "'" if "'" not in name else '"'
    if quote in name:
        raise ValueError(f"an attribute name cannot hold both kinds of quotes: {name!r}")
    return f"[{quote}{name}{quote}]"


def is_plain(attribute: Attribute, kind: str) -> bool:
    """A number or string that stands in the image itself, for which ``change_record`` is enough."""
    return isinstance(attribute, str) and kind in ("N", "S")
