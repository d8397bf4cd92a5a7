"""Work lists: what is left to do, what is done, and what to leave out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import names
from ledgerloom.functions.cells import strip
from ledgerloom.functions.names import stem
from ledgerloom.operators.joins import keep_listed, left_lookup, spread_join
from ledgerloom.operators.latest import one_per_group
from ledgerloom.session import settle


def document_worklist(index: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Distinct non-blank paths, for the given ``stock_code`` rows only when given."""
    rows = index.where(F.trim("pdf_path") != "")
    if codes is not None:
        rows = keep_listed(rows, codes, [("stock_code", "stock_code")])
    return rows.select("pdf_path").distinct()


def pending_list(
    full: DataFrame, ignore: DataFrame, existing: DataFrame, key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Ids of ``full`` in neither other list, in their order, and the four counts.

    The order is ``seq``, and ``position`` within it where the list has one.

    Repeated ids of the full list stay; both other lists count once per id.
    The two lists make one set of ids, so the full list shuffles once.
    """
    done = ignore.select(key).unionByName(existing.select(key))
    pending = keep_listed(full, done, [(key, key)], listed=False)
    tagged = (
        full.select(F.lit("full").alias("list"), F.lit(1).alias("n"))
        .unionByName(ignore.select(key).distinct().select(F.lit("ignore").alias("list"), F.lit(1).alias("n")))
        .unionByName(existing.select(key).distinct().select(F.lit("existing").alias("list"), F.lit(1).alias("n")))
        .unionByName(pending.select(F.lit("pending").alias("list"), F.lit(1).alias("n")))
    )
    counts = tagged.agg(
        *[
            F.count_if(F.col("list") == name).alias(f"total_{name}")
            for name in ("full", "ignore", "existing", "pending")
        ]
    )
    order = [c for c in ("seq", "position") if c in full.columns]
    return pending.orderBy(*order), counts


def update_ignore(
    ignore: DataFrame, summary: DataFrame, statuses: tuple[str, ...] = ("saved",)
) -> tuple[DataFrame, DataFrame]:
    """Append the ids that reached a status, in order of first appearance.

    ``ignore`` is ``seq, id``; ``summary`` is ``seq, stock_id, status``. Returns
    the list as ``part, seq, id`` (part 0 old, part 1 new; that is its order)
    and the count of new ids.
    """
    reached = summary.select(
        "seq", strip(F.col("stock_id").cast("string")).alias("id"), strip(F.col("status")).alias("status")
    ).where((F.col("id") != "") & F.col("status").isin(*statuses))
    first = reached.groupBy("id").agg(F.min("seq").alias("seq"))
    new = keep_listed(first, ignore, [("id", "id")], listed=False)
    updated = ignore.select(F.lit(0).alias("part"), "seq", "id").unionByName(
        new.select(F.lit(1).alias("part"), "seq", "id")
    )
    return updated, new.agg(F.count("*").alias("added"))


def skip_done(
    documents: DataFrame, done: DataFrame, name: str = "document_name", done_name: str = "document_name"
) -> DataFrame:
    """Documents whose file stem is not among the stems already done.

    The stems are compared without the texts. The list of what is left is then
    written down, so that a short one is sent to the texts instead of the texts
    being shuffled to it.
    """
    stems = done.select(stem(F.col(done_name)).alias("_stem"))
    found = documents.select(stem(F.col(name)).alias("_stem")).distinct()
    left = settle(keep_listed(found, stems, [("_stem", "_stem")], listed=False), "left")
    return spread_join(documents, left, [(stem(F.col(name)), "_stem")], "left_semi")


def apply_path_map(
    index: DataFrame, mapping: DataFrame, order: list[Column | str], path: str = "pdf_path"
) -> DataFrame:
    """Replace paths by ``mapping(old_path, new_path, …order)``.

    The first mapping of a path wins and changes every row with that path.
    """
    chosen = one_per_group(mapping, ["old_path"], order).select("old_path", "new_path")
    return left_lookup(index, chosen, [(path, "old_path")]).withColumn(
        path, F.coalesce("new_path", path)
    ).drop("new_path")


def archive_paths(index: DataFrame, order: list[Column | str]) -> DataFrame:
    """Point the index at archive names: the first row of each path names its file."""
    code, path = F.col("stock_code"), F.col("pdf_path")
    new = names.archive_path(code, path)
    named = index.where((F.trim("pdf_path") != "") & (names.base_name(path) != names.base_name(new)))
    mapping = named.select(path.alias("old_path"), new.alias("new_path"), *order)
    return apply_path_map(index, mapping, order)


def restore_paths(index: DataFrame, order: list[Column | str]) -> DataFrame:
    """Point archived rows of the index back at the original files."""
    path = F.col("pdf_path")
    archived = index.where(
        path.like(names.ARCHIVE_DIR + "/%")
        & F.startswith(names.base_name(path), names.archive_prefix(F.col("stock_code")))
        & (names.original_name(names.base_name(path)) != "")
    )
    mapping = archived.select(
        path.alias("old_path"), names.original_path(path).alias("new_path"), *order
    )
    return apply_path_map(index, mapping, order)
