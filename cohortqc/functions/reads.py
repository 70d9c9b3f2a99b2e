"""Predicates and clean-up of one sequencing read (all codegen expressions, no Python per row)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INCOMPLETE, BAD_ENCODING, UNEQUAL, MIXED = "incomplete", "bad_encoding", "unequal_length", "header_mismatch"

# blanks that a reader strips from both ends of a line
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "


def decode(value: Column) -> Column:
    """Drop everything outside ASCII, then strip surrounding blanks; null stays null.

    A string with as many bytes as characters is ASCII already and skips the pattern.
    """
    ascii_only = F.when(F.octet_length(value) == F.length(value), value).otherwise(
        F.regexp_replace(value, r"[^\x00-\x7F]", ""))
    return F.btrim(ascii_only, F.lit(BLANKS))


def strip_control(value: Column) -> Column:
    """Drop control characters and spaces."""
    return F.regexp_replace(value, r"[\x00-\x20]", "")


def is_incomplete(qual: Column) -> Column:
    return qual.isNull()


def is_invalid_seq(seq: Column) -> Column:
    return ~seq.rlike(r"^[ACGTNacgtn]*\z")


def is_invalid_qual(qual: Column) -> Column:
    return ~qual.rlike(r"^[!-~]*\z")


def is_invalid_header(header: Column, strict: bool = False) -> Column:
    """Printable ASCII only. Off by default: headers are never rejected unless asked for."""
    return ~header.rlike(r"^[ -~]*\z") if strict else F.lit(False)


def is_wrong_encoding(h1: Column, seq: Column, qual: Column, strict_header: bool = False) -> Column:
    bad = is_invalid_seq(seq) | is_invalid_qual(qual)
    return (is_invalid_header(h1, True) | bad) if strict_header else bad


def is_unequal(seq: Column, qual: Column) -> Column:
    return F.length(seq) != F.length(qual)


def is_different_header(a: Column, b: Column) -> Column:
    """Headers of two mates differ in length or in more than one character, ``length=<n>`` aside."""
    left, right = (F.regexp_replace(c, r"length=[0-9]+", "") for c in (a, b))
    differences = F.size(F.filter(
        F.zip_with(F.split(left, ""), F.split(right, ""), lambda x, y: ~x.eqNullSafe(y)), lambda d: d))
    return F.when(left == right, False).otherwise((F.length(left) != F.length(right)) | (differences > 1))


def is_abi(seq: Column) -> Column:
    """Colour-space sequence: a T followed by digits and dots."""
    return seq.rlike(r"^T[0-9.]+\z")


def reject_reason(h1: Column, seq: Column, qual: Column, strict_header: bool = False) -> Column:
    """First failing rule of a single read, null when the read is good."""
    return (F.when(is_incomplete(qual), INCOMPLETE)
            .when(is_wrong_encoding(h1, seq, qual, strict_header), BAD_ENCODING)
            .when(is_unequal(seq, qual), UNEQUAL))


def pair_reject_reason(reason1: Column, reason2: Column, h1: Column, h2: Column) -> Column:
    """First failing rule of a pair, from the verdicts of its mates and their headers.

    The rules come in one order for mates and pairs, so the earlier of the two verdicts is the pair's.
    """
    def either(what: str) -> Column:
        return reason1.eqNullSafe(F.lit(what)) | reason2.eqNullSafe(F.lit(what))

    return (F.when(either(INCOMPLETE), INCOMPLETE).when(either(BAD_ENCODING), BAD_ENCODING)
            .when(either(UNEQUAL), UNEQUAL).when(is_different_header(h1, h2), MIXED))
