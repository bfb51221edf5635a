"""Bases, codons, alleles and k-mers as Column expressions."""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Genetic code 11 (and 1, which differs in start codons only), codons in the order TCAG.
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
STARTS = {1: "---M------**--*----M---------------M----------------------------", 11: "---M------**--*----M------------MMMM---------------M------------"}


def codon_table(table: int = 11) -> list[tuple[str, str, str, float]]:
    """(codon, amino, start, n_sites): n_sites is the third of the nine single changes that alter the amino acid."""
    codons = ["".join(c) for c in product("TCAG", repeat=3)]
    amino = dict(zip(codons, AMINO))
    sites = {c: sum(amino[c[:i] + b + c[i + 1 :]] != amino[c] for i in range(3) for b in "TCAG" if b != c[i]) / 3 for c in codons}
    return [(c, amino[c], s, sites[c]) for c, s in zip(codons, STARTS[table])]


def as_dna(text: Column) -> Column:
    """Letters of a text as bases: what isn't a-z goes, the rest is dealt over A, C, G and T by place in the alphabet."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_replace(F.lower(text), "[^a-z]", ""), letters, ("ACGT" * 7)[:26])


def is_regular(seq: Column) -> Column:
    return seq.rlike("^[ACGT]+$")


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), "ACGTN", "TGCAN")


def codons(seq: Column, frame: Column, strand: Column) -> Column:
    """array<string>; the minus strand is read from its reverse complement, a short last piece is kept."""
    s = F.when(strand == "-", reverse_complement(seq)).otherwise(seq)
    s = F.substr(s, frame + 1)
    return F.regexp_extract_all(s, F.lit("(.{1,3})"), F.lit(1))


def kmers(seq: Column, k: int) -> Column:
    """All k-mers in order. One pass of a lookahead; taking substrings by place would walk the text again for each."""
    return F.regexp_extract_all(seq, F.lit(f"(?=(.{{{k}}}))"), F.lit(1))


def kmer_rows(df: DataFrame, seq: str, k: int, out: str = "k", size: int = 1 << 14) -> DataFrame:
    """A row for each k-mer of each sequence. Sequences are cut in pieces that overlap by k - 1 letters first, so that a contig's k-mers are never one array."""
    raw = F.col(seq).cast("binary")
    n = F.octet_length(seq)
    pieces = F.when(n >= k, F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1)), F.lit(size)), lambda at: F.substr(raw, at, F.lit(size + k - 1)).cast("string"))).otherwise(F.array().cast("array<string>"))
    return df.select(F.explode(pieces).alias("__piece")).select(F.explode(kmers(F.col("__piece"), k)).alias(out))


_CODE = np.full(256, 4, np.uint8)
_CODE[np.frombuffer(b"ACGT", np.uint8)] = range(4)
#: Codes that a task sorts at once, and ids up to which their table is broadcast: 16 MB.
_CODES, _FEW = 1 << 22, 1_000_000


def _coded(raw: bytes, k: int) -> np.ndarray:
    """The k-mers of bases A, C, G and T (k of 31 or less) as numbers, two bits a base."""
    base = _CODE[np.frombuffer(raw, np.uint8)].astype(np.int64)
    if base.size and base.max() > 3:
        raise ValueError("k-mers are coded over A, C, G and T only")
    n, out, have = len(base) - k + 1, base, 1
    # codes of 2, 4, 8 ... letters, then those of the rest
    parts = {1: base}
    while 2 * have <= k:
        out = (parts[have][: len(base) - 2 * have + 1] << (2 * have)) | parts[have][have:]
        have *= 2
        parts[have] = out
    got, at = np.zeros(n, np.int64), 0
    for size in sorted(parts, reverse=True):
        if k - at >= size:
            got = (got << (2 * size)) | parts[size][at : at + n]
            at += size
    return got


def _multiplicities(raw: bytes, k: int):
    """(codes, how often each occurs) of a text, so many letters at a time and by the codes' rest, that memory doesn't grow with the text beyond its bytes."""
    n = len(raw) - k + 1
    parts = -(-n // _CODES)
    for rest in range(parts):
        held = []
        for at in range(0, n, _CODES):
            codes = _coded(raw[at : at + _CODES + k - 1], k)
            held.append(codes if parts == 1 else codes[codes % parts == rest])
        yield np.unique(np.concatenate(held), return_counts=True)


def kmer_multiplicities(df: DataFrame, id_col: str, seq: str, k: int) -> DataFrame:
    """(id, edges, threaded, most): of the k-mers of an id's sequences over A, C, G and T, how many there are, with repeats, and how often the most frequent one occurs. Ids without any have no row.

    k-mers of one row are counted where it is. Only those of ids that repeat are sent, as numbers with their counts in the row."""
    rows = df.where(F.length(seq) >= k).select(F.col(id_col).alias("__id"), F.col(seq).alias("__seq"))
    kind = rows.schema["__id"].dataType.simpleString()

    def totals(batches):
        for b in batches:
            got = []
            for raw in b.column(1).cast(pa.binary()):
                edges, threaded, most = 0, 0, 0
                for _, n in _multiplicities(raw.as_py(), k):
                    edges, threaded, most = edges + len(n), threaded + int(n.sum()), max([most, *n[n > most]])
                got.append((edges, threaded, int(most)))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([g[i] for g in got], pa.int64()) for i in range(3))], ["__id", "edges", "threaded", "most"])

    def spread(batches):
        for b in batches:
            for at, raw in enumerate(b.column(1).cast(pa.binary())):
                for codes, n in _multiplicities(raw.as_py(), k):
                    for s in range(0, len(codes), 1 << 16):
                        part = codes[s : s + (1 << 16)]
                        ids = b.column(0).take(pa.array(np.full(len(part), at)))
                        yield pa.RecordBatch.from_arrays([ids, pa.array(part), pa.array(n[s : s + (1 << 16)].astype(np.int64))], ["__id", "code", "n"])

    again = rows.groupBy("__id").count().where("count > 1").select(F.col("__id").alias("__again"))
    many = again.limit(_FEW + 1).count()
    one = rows
    out = None
    if many:
        again = F.broadcast(again) if many <= _FEW else again.hint("merge")
        on = F.col("__id").eqNullSafe(F.col("__again"))
        one = rows.join(again, on, "left_anti")
        sent = rows.join(again, on, "left_semi").mapInArrow(spread, f"__id {kind}, code long, n long").groupBy("__id", "code").agg(F.sum("n").alias("n"))
        out = sent.groupBy("__id").agg(F.count("*").alias("edges"), F.sum("n").alias("threaded"), F.max("n").alias("most"))
    counted = one.mapInArrow(totals, f"__id {kind}, edges long, threaded long, most long")
    return (counted if out is None else counted.unionByName(out)).withColumnRenamed("__id", id_col)


def gc(seq: Column) -> Column:
    return F.length(F.regexp_replace(seq, "[^GC]", "")) / F.length(seq)


def allele_type(ref: Column, alt: Column) -> Column:
    """SNP, MNP, INDEL or SYMBOLIC of a biallelic site."""
    return F.when(alt.rlike(r"^<.*>$") | (alt == "*") | alt.rlike(r"[\[\]]"), "SYMBOLIC").when(F.length(ref) != F.length(alt), "INDEL").when(F.length(ref) == 1, "SNP").otherwise("MNP")


def variant_type(ref: Column, alts: Column) -> Column:
    """As ``allele_type`` for one kind of alt; MIXED if they differ; NO_VARIATION without alts."""
    kinds = F.array_distinct(F.transform(alts, lambda a: allele_type(ref, a)))
    return F.when(F.size(alts) == 0, "NO_VARIATION").when(F.size(kinds) > 1, "MIXED").otherwise(kinds[0])


def allele_class(bases: Column) -> Column:
    return (
        F.when(bases == ".", "NO_CALL").when(bases == "*", "SPAN_DEL").when(bases.rlike(r"^<.+>$"), "SYMBOLIC").when(bases.rlike(r"[\[\]]"), "BREAKEND").when(bases.rlike("^[ACGTNacgtn]+$"), "BASES").otherwise("INVALID")
    )


def common_prefix(a: Column, b: Column) -> Column:
    n = F.least(F.length(a), F.length(b))
    at = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)))
    return F.when(n == 0, 0).when(F.size(at) > 0, F.array_min(at) - 1).otherwise(n)


def common_suffix(a: Column, b: Column) -> Column:
    return common_prefix(F.reverse(a), F.reverse(b))


def trim_alleles(ref: Column, alt: Column) -> Column:
    """struct<ref, alt, shift>: the common suffix goes, then the common prefix; one base of each stays."""
    keep = lambda x, n: F.substr(x, F.lit(1), F.length(x) - n)
    most = F.least(F.length(ref), F.length(alt)) - 1
    s = F.least(common_suffix(ref, alt), most)
    r, a = keep(ref, s), keep(alt, s)
    p = F.least(common_prefix(r, a), F.least(F.length(r), F.length(a)) - 1)
    return F.struct(F.substr(r, p + 1).alias("ref"), F.substr(a, p + 1).alias("alt"), p.alias("shift"))


def repeat_unit(bases: Column) -> Column:
    """Shortest unit whose repetition makes the whole."""
    return F.regexp_extract(bases, r"^(.+?)\1*$", 1)


def leading_repeats(unit: Column, bases: Column) -> Column:
    """How many whole copies of ``unit`` the sequence starts with."""
    n = F.floor(F.length(bases) / F.length(unit)).cast("int")
    whole = F.filter(F.sequence(F.lit(0), n), lambda i: F.startswith(bases, F.repeat(unit, i)))
    return F.array_max(whole)


def trailing_repeats(unit: Column, bases: Column) -> Column:
    n = F.floor(F.length(bases) / F.length(unit)).cast("int")
    return F.array_max(F.filter(F.sequence(F.lit(0), n), lambda i: F.endswith(bases, F.repeat(unit, i))))


def plain_kind(ref: Column, alt: Column) -> Column:
    """Kind of an allele by lengths: NONE (equal bases), SNV, MNV, DEL or INS; symbolic <DEL>, <INS>, <INV>, <DUP> by name, other symbols SV."""
    by_name = F.regexp_extract(alt, "^<(DEL|INS|INV|DUP)", 1)
    return (
        F.when(alt.rlike("^<.*>$"), F.when(by_name == "", "SV").otherwise(by_name)).when(ref == alt, "NONE").when(F.length(ref) > F.length(alt), "DEL").when(F.length(ref) < F.length(alt), "INS").when(F.length(ref) == 1, "SNV").otherwise("MNV")
    )


def kind_length(kind: Column, ref: Column, alt: Column) -> Column:
    return F.when(kind.isin("DEL", "INS"), F.abs(F.length(ref) - F.length(alt))).when(kind == "MNV", F.length(alt)).otherwise(1)


def kind_end(kind: Column, start: Column, length: Column) -> Column:
    """First base after a deletion or block; the next base of an insertion or inversion; the base itself of others."""
    return F.when(kind.isin("DEL", "MNV"), start + length).when(kind.isin("INS", "INV"), start + 1).otherwise(start)


def strand_rates(bias: Column) -> Column:
    """struct<forward, reverse>: natural logs of the rates of a strand bias (NONE, FORWARD or REVERSE)."""
    sure, never, half = F.lit(0.0), F.lit(float("-inf")), F.lit(0.5)
    rate = lambda own: F.when(bias == own, sure).when(bias == "NONE", F.ln(half)).otherwise(never)
    return F.struct(rate("FORWARD").alias("forward"), rate("REVERSE").alias("reverse"))


def percentage(value: Column) -> Column:
    """A share given as 0 to 1 or as 1 to 100 per cent: 1 and more is divided by 100. Null: 0. Anything outside 0 to 100 is an error."""
    bad = F.raise_error(F.concat(F.lit("Invalid percentage: "), value.cast("string")))
    return F.when(value.isNull(), 0.0).when((value >= 0) & (value < 1), value.cast("double")).when((value >= 1) & (value <= 100), value / 100.0).otherwise(bad)
