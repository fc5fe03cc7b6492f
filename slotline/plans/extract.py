"""The extract of one or more days, from tables to records and files."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotline.layouts.records import FILE_HEADER, FILE_TRAILER
from slotline.operators import records, selection
from slotline.operators.lines import SECTION_RANK
from slotline.operators.naming import file_name
from slotline.operators.numbering import number_claims
from slotline.operators.ordered import dealt_once
from slotline.operators.payments import responses_of
from slotline.sinks.files import in_task_order, write_files
from slotline.sinks.relation import write_relation
from slotline.sources.claims import claim_keys, is_delivered, is_staged, keyed_claims

# Records that a task puts into one part of a file, more or less.
RECORDS_PER_PART = 50_000


@dataclass
class Extract:
    """All results of a run.

    ``claims``, ``payments`` and ``parameters`` are the three input relations.
    ``strict_sequence`` sorts records by ``record_sequence`` alone and
    ``strict_nulls`` leaves a trailer NULL where no claim of its file has lines;
    with ``strict_values`` the first number or flag that cannot be read ends the run.
    All are off, which gives files that are whole and in order.
    """

    claims: DataFrame
    payments: DataFrame
    parameters: DataFrame
    strict_sequence: bool = False
    strict_nulls: bool = False
    strict_values: bool = False

    @cached_property
    def selected(self) -> DataFrame:
        """``(id, mac_id, receipt_date, line_count, extract_date)`` of the claims of the days; of claims given as text each once.

        Claims given as text are not stored, as ``phased`` is made once an action.
        """
        on_days = lambda claims: selection.claims_on_date(claims.select("id", "mac_id", "receipt_date", "line_count"), self.parameters)
        if is_delivered(self.claims):
            # A staged table has each claim once.
            return on_days(self._claims_of_days)
        if is_staged(self.claims):
            # Several steps start from these narrow rows.
            return selection.each_once(on_days(self._claims_of_days)).persist(StorageLevel.MEMORY_AND_DISK)
        return selection.each_once(on_days(self._known)).unionByName(selection.each_once(on_days(self._unknown)))

    @cached_property
    def phased(self) -> DataFrame:
        """``(id, mac_id, receipt_date, line_count, extract_date, phase)``, narrow."""
        if is_staged(self.claims):
            return selection.with_phase(self.selected, responses_of(self.payments.select("claim_id"), self.selected))
        # Claims given as text would be parsed once more to drop the ids of others, which are narrow and shrink before they move.
        # The day as text isn't carried along but written anew.
        phased = selection.with_phase(self.selected, self.payments.select("claim_id")).drop("receipt_date")
        return dealt_once(phased).withColumn("receipt_date", selection.day_text())

    @cached_property
    def numbered(self) -> DataFrame:
        """Claim numbers and file totals."""
        narrow = number_claims(self.phased.drop("receipt_date"), self.strict_nulls)
        return narrow.withColumn("receipt_date", selection.day_text())

    def mac_dimension(self) -> DataFrame:
        return selection.mac_dimension(self.phased)

    def mac_totals(self) -> DataFrame:
        return selection.mac_totals(self.phased, self.strict_nulls)

    def file_header(self) -> DataFrame:
        totals = self.mac_dimension().select(
            "*", F.lit(None).cast("bigint").alias("total_claim_headers"), F.lit(None).cast("bigint").alias("total_claim_lines")
        )
        return records.file_records(totals, FILE_HEADER)

    def file_trailer(self) -> DataFrame:
        return records.file_records(self.mac_totals(), FILE_TRAILER)

    def file_metadata(self) -> DataFrame:
        return self.mac_dimension().join(self.parameters, "extract_date").select(
            *selection.FILE, file_name(F.col("phase"), F.col("mac_id"), F.col("run_ts")).alias("file_name")
        )

    def claim_rows(self) -> DataFrame:
        # Names are long and made where the documents are; the run's time is what they are made of.
        timed = self.numbered.join(self.parameters, "extract_date")
        claims = self._claims_of_days if is_staged(self.claims) else self._known
        rows = records.claim_rows(timed, claims, responses_of(self.payments, self.selected if is_staged(self.claims) else self.phased))
        return rows.withColumn("file_name", file_name(F.col("phase"), F.col("mac_id"), F.col("run_ts")))

    def all_records(self, *sections: str) -> DataFrame:
        """Unordered records with their text; all sections when none is named."""
        return records.records_of(self.claim_rows(), sections or tuple(SECTION_RANK), strict_values=self.strict_values)

    def final(self) -> DataFrame:
        """The ordered result relation.

        Claims are placed by their known running numbers and sorted within tasks, then each becomes
        its records in place: nothing is sampled, and neither the records nor their text are shuffled.
        Only the strict order, which moves trailers between claims, has to sort the records themselves.
        """
        if self.strict_sequence:
            unordered = records.records_of(self.claim_rows(), compact=True, strict_values=self.strict_values)
            ordered = unordered.orderBy("file_name", *records.record_order(strict_sequence=True))
            ordered = ordered.withColumn("record_content", records.text_of_slots())
        else:
            ordered = records.records_of(
                self._placed(RECORDS_PER_PART).sortWithinPartitions("file_name", "part", "claim_sequence"),
                strict_values=self.strict_values,
            )
        return ordered.select(*records.RECORD_COLUMNS, "record_content")

    def write(self, path: str, records_per_part: int = RECORDS_PER_PART, compression: str = "none") -> None:
        """One folder per file name, whose text is its files in the order of their numbers.

        Claims are placed by running number of parts, of about ``records_per_part`` records each,
        before they are turned into records: a file of any size is written by many tasks, and
        only claims are shuffled.  Of ``path`` only the folders of this run's files are replaced.
        Files are plain text, or with a ``compression`` of Spark's text writer (such as ``gzip``) packed by it.
        """
        placed = self._placed(records_per_part)
        compact = records.records_of(placed, compact=True, strict_values=self.strict_values)
        write_files(compact, path, records.text_of_slots(), records.record_order(self.strict_sequence), compression)

    def store(self, path: str, records_per_part: int = RECORDS_PER_PART) -> None:
        """The ordered result relation as a table that keeps its order; ``sinks.read_relation`` reads it."""
        compact = records.records_of(self._placed(records_per_part), compact=True, strict_values=self.strict_values)
        write_relation(compact, path, records.text_of_slots(), records.record_order(self.strict_sequence))

    def _placed(self, records_per_part: int) -> DataFrame:
        """Claims in tasks by file and ``part``, the running number of parts of so many records."""
        rows = self.claim_rows().withColumn("part", F.floor(F.col("records_before") / records_per_part))
        held = F.col("total_claim_headers") + F.coalesce("total_claim_lines", F.lit(0))
        parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(held / records_per_part)))
        return in_task_order(rows, records.named(self.mac_totals(), self.parameters).select("file_name", parts.alias("part")))

    @cached_property
    def _known(self) -> DataFrame:
        """Claims with an id: the only ones with records. The filter that a join by id has is here for all steps."""
        return self._claims_of_days.where("id is not null")

    @cached_property
    def _unknown(self) -> DataFrame:
        """A claim without id is counted in its file."""
        return self._claims_of_days.where("id is null")

    @cached_property
    def _claims_of_days(self) -> DataFrame:
        """The claims received from the least to the greatest wanted day, before anything is joined.

        Of a staged claim table these are folders, so that others are never listed or read;
        documents given as text are dropped before they are shuffled.  Other days in between
        are left to the join with the parameters.
        """
        days = self.parameters.agg(
            F.date_format(F.min("extract_date"), "yyyy-MM-dd").alias("first"),
            F.date_format(F.max("extract_date"), "yyyy-MM-dd").alias("last"),
        )
        if is_staged(self.claims):
            return self.claims.where(F.col("receipt_date").between(days.select("first").scalar(), days.select("last").scalar()))
        keyed = keyed_claims(self.claims)
        between = F.col("receipt_date").between(days.select("first").scalar(), days.select("last").scalar())
        return keyed.where(F.col("mac_id").isNotNull() & between)
