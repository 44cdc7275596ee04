"""Value rules and aggregates by name, with room for a site's own ones."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from waferline.functions import aggregates, values


@dataclass
class Registry:
    """Built-ins plus registered functions; a registered name wins over a built-in one."""

    own_values: dict[str, Callable[[], Column]] = field(default_factory=dict)
    own_aggs: dict[str, Callable[[Column, list[Column]], Column]] = field(default_factory=dict)

    def register_value(self, name: str, fn: Callable[[], Column]) -> None:
        self.own_values[name] = fn

    def register_agg(self, name: str, fn: Callable[[Column, list[Column]], Column]) -> None:
        self.own_aggs[name] = fn

    def has_value(self, name: str) -> bool:
        return name in self.own_values or name in values.VALUES

    def value(self, name: str) -> Column | None:
        fn = self.own_values.get(name) or values.VALUES.get(name)
        return fn() if fn else None

    def text_agg(self, name: str) -> aggregates.TextAgg | None:
        if name in self.own_aggs:
            return aggregates.TextAgg(own=self.own_aggs[name])
        return aggregates.TEXT_AGGS.get(name)

    def number_agg(self, name: str) -> Callable[[Column, list[Column]], Column] | None:
        return aggregates.NUMBER_AGGS.get(name) or self.own_aggs.get(name)
