"""Names that carry the data provider.

The provider of the landed responses is part of some field names (``<name>_ids``)
and column labels (``<Name> Track ID``). Jobs take it as a parameter.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Provider:
    name: str = ""

    def label(self, text: str) -> str:
        return f"{self.name} {text}" if self.name else text

    def member(self, text: str) -> str:
        return f"{self.name.lower()}_{text}" if self.name else text


NO_PROVIDER = Provider()
