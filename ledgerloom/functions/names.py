"""File names: parts, dates and the archive naming scheme."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Archive layout and the date used when a name has none.
ARCHIVE_DIR = "data/processed/auditor_pdfs"
ORIGINAL_DIR = "data/raw/auditor_pdfs"
NO_DATE = "00000000"

_EXTENSION = r"\A\.*[^.].*(\.[^.]*)\z"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def drop_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def extension(name: Column) -> Column:
    """The last dot and what follows; '' when there is none."""
    return F.regexp_extract(name, "(?s)" + _EXTENSION, 1)


def split_stem(name: Column) -> Column:
    return F.left(name, F.length(name) - F.length(extension(name)))


def stem(path: Column) -> Column:
    """File name without its last suffix; a lone trailing dot is no suffix."""
    return F.regexp_replace(base_name(path), r"(?s)\A(.+)\.[^.]+\z", "$1")


def name_date(name: Column) -> Column:
    """First eight digits in a row as ``YYYY-MM-DD`` text, else ''."""
    digits = F.regexp_extract(name, "([0-9]{8})", 1)
    return F.when(digits == "", F.lit("")).otherwise(
        F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
    )


def archive_prefix(code: Column) -> Column:
    return F.concat(F.lit("[c"), code.cast("string"), F.lit("]-["))


def archive_name(code: Column, path: Column) -> Column:
    """``[c<code>]-[<date>]-[<rest>]-[<stem>]<ext>``; a name already so built stays."""
    name = base_name(path)
    ext = extension(name)
    core = split_stem(name)
    digits = F.regexp_extract(core, "([0-9]{8})", 1)
    dated = digits != ""
    rest = F.when(dated, F.regexp_extract(core, r"(?s)\A.*?[0-9]{8}(.*)\z", 1)).otherwise(core)
    built = F.concat(
        archive_prefix(code),
        F.when(dated, digits).otherwise(F.lit(NO_DATE)),
        F.lit("]-["), rest, F.lit("]-["), core, F.lit("]"), ext,
    )
    return F.when(F.startswith(name, archive_prefix(code)), name).otherwise(built)


def original_name(name: Column) -> Column:
    """The name an archive name was built from; '' when it is not one.

    The stem ends in the rest part, so a stem with brackets of its own still
    divides in one way.
    """
    parts = (
        r"(?s)\A\[c[^\]]*\]-\[([0-9]{8})\]-\[(.*)\]-\[((?:.*?\1)?\2)\](\.[^.\]]*)?\z"
    )
    return F.concat(F.regexp_extract(name, parts, 3), F.regexp_extract(name, parts, 4))


def archive_path(code: Column, path: Column, folder: str = ARCHIVE_DIR) -> Column:
    return F.concat(F.lit(folder + "/"), archive_name(code, path))


def original_path(path: Column, folder: str = ORIGINAL_DIR) -> Column:
    return F.concat(F.lit(folder + "/"), original_name(base_name(path)))


def id_from_name(path: Column, prefix: str = "press_releases_", suffix: str = ".csv") -> Column:
    """The id inside ``<prefix><id><suffix>``; NULL when the name has another form."""
    name = base_name(path)
    found = F.startswith(name, F.lit(prefix)) & F.endswith(name, F.lit(suffix))
    inner = F.substring(
        name, F.lit(len(prefix) + 1), F.length(name) - F.lit(len(prefix) + len(suffix))
    )
    return F.when(found & (F.length(name) > len(prefix) + len(suffix)), inner)
