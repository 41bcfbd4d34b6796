"""Where a table's credentials come from: sources by name, which give Hadoop settings for the file systems under its roots."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import SparkSession

PREFIX = "hadoop."


def from_properties(options: Any) -> dict[str, str]:
    """properties.hadoop.<setting> of the options; in their values {username} and {token} stand for these options."""
    named = {k: options[k] or "" for k in ("username", "token")}
    return {k.removeprefix(PREFIX): v.replace("{username}", named["username"]).replace("{token}", named["token"]) for k, v in options.properties.items() if k.startswith(PREFIX)}


#: By name, in lower case. A program adds its own, say one that asks a vault.
SOURCES: dict[str, Callable[[Any], Mapping[str, str]]] = {"session": lambda options: {}, "options": from_properties}


def credentials(options: Any) -> Mapping[str, str]:
    """The settings of the options' credentials-source; without one the session's own hold."""
    name = (options["credentials-source"] or "session").lower()
    if name not in SOURCES:
        raise ValueError(f"there is no credentials source {name!r}; known: {', '.join(sorted(SOURCES))}")
    return SOURCES[name](options)


def apply(spark: SparkSession, options: Any) -> None:
    """Hands the settings to the file systems that the session opens from now on."""
    conf = spark._jsc.hadoopConfiguration()
    for k, v in credentials(options).items():
        conf.set(k, v)
