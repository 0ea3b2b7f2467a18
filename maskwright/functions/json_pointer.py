"""JSON pointers: read, set, and walk of string leaves."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


def escape(token: object) -> str:
    return str(token).replace("~", "~0").replace("/", "~1")


def _tokens(pointer: str) -> list[str]:
    if pointer == "":
        return []
    if not pointer.startswith("/"):
        raise ValueError("a pointer starts with /")
    return [t.replace("~1", "/").replace("~0", "~") for t in pointer[1:].split("/")]


def _child(node, token: str):
    if isinstance(node, list):
        if not token.isdigit() or int(token) >= len(node):
            raise KeyError(token)
        return int(token)
    if not isinstance(node, dict) or token not in node:
        raise KeyError(token)
    return token


def get(document, pointer: str):
    for token in _tokens(pointer):
        document = document[_child(document, token)]
    return document


def put(document, pointer: str, value) -> None:
    """Replace what a pointer leads to; it must exist."""
    *path, last = _tokens(pointer)
    for token in path:
        document = document[_child(document, token)]
    document[_child(document, last)] = value


def leaves(document, base: str = "") -> Iterator[tuple[str, str]]:
    """Pointer and value of every string below ``base``."""
    if isinstance(document, str):
        yield base, document
    elif isinstance(document, dict):
        for key, value in document.items():
            yield from leaves(value, f"{base}/{escape(key)}")
    elif isinstance(document, list):
        for i, value in enumerate(document):
            yield from leaves(value, f"{base}/{i}")


@udtf(returnType="pointer: string, value: string")
class JsonWalk:
    """Rows of the string leaves of a JSON text; none for null or malformed ones."""

    def eval(self, text: str):
        try:
            document = json.loads(text) if text is not None else None
        except ValueError:
            return
        yield from leaves(document)


def register_walk(spark: SparkSession) -> None:
    spark.udtf.register("json_walk", JsonWalk)
