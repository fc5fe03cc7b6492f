"""A record layout: constant bytes with data slots between them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LAYOUT_TABLE = (
    "record_type string, field_name string, `start` int, `end` int, "
    "pad_side string, pad_len int, pad_char string, line int"
)


@dataclass(frozen=True)
class Slot:
    """Positions ``start`` to ``end`` (1-based, inclusive) hold one padded value.

    ``pad`` is the side and the fill, such as ``L0``.  ``source`` names the value:
    ``claim.key``, ``payment.key``, ``line.key`` (falling back to the claim's key
    of the same name) or ``@name`` for a value the record builder works out.
    A default of ``None`` lets a missing value make the whole record NULL.
    """

    start: int
    end: int
    name: str
    pad: str
    source: str
    default: str | None = ""
    form: str = "text"

    @property
    def width(self) -> int:
        return self.end - self.start + 1

    def padded(self, value: Column) -> Column:
        pad = F.lpad if self.pad[0] == "L" else F.rpad
        return pad(value, self.width, self.pad[1])


@dataclass(frozen=True)
class Layout:
    record_type: str
    width: int
    slots: tuple[Slot, ...]
    zeros: str = ""
    constants: tuple[tuple[int, str], ...] = ()

    def blank_record(self) -> str:
        """The record with every data slot left blank."""
        text = [" "] * self.width
        for run in self.zeros.split():
            first, _, last = run.partition("-")
            for position in range(int(first), int(last or first) + 1):
                text[position - 1] = "0"
        for start, constant in self.constants:
            text[start - 1 : start - 1 + len(constant)] = constant
        return "".join(text)

    def pieces(self) -> list[str | Slot]:
        """Constants and slots in record order, neighbouring constants merged."""
        blank, at, out = self.blank_record(), 1, []
        for slot in self.slots:
            if slot.start > at:
                out.append(blank[at - 1 : slot.start - 1])
            out.append(slot)
            at = slot.end + 1
        if at <= self.width:
            out.append(blank[at - 1 :])
        return out

    def render(self, values) -> Column:
        """The record text; ``values(i)`` is the unpadded column of slot ``i``.

        Every position belongs to one constant or one padded slot, so the text
        has the record's width without padding it once more as a whole.
        """
        parts, i = [], 0
        for piece in self.pieces():
            if isinstance(piece, Slot):
                parts.append(piece.padded(values(i)))
                i += 1
            else:
                parts.append(F.lit(piece))
        return F.concat(*parts)

    def rows(self) -> list[tuple]:
        """Layout table rows: the data slots and the constant runs between them."""
        out, at = [], 1
        for line, piece in enumerate(self.pieces(), start=1):
            if isinstance(piece, Slot):
                side = "LPAD" if piece.pad[0] == "L" else "RPAD"
                out.append((self.record_type, piece.name, piece.start, piece.end, side, piece.width, piece.pad[1], line))
                at = piece.end + 1
            else:
                end = at + len(piece) - 1
                out.append((self.record_type, "CONSTANT", at, end, "RPAD", len(piece), " ", line))
                at = end + 1
        return out


def layout_table(spark: SparkSession, layouts) -> DataFrame:
    return spark.createDataFrame([row for layout in layouts for row in layout.rows()], LAYOUT_TABLE)
