"""Quality scores, log10 arithmetic and genotype likelihoods as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MOST_QUAL = 254
#: PLs are capped here.
MOST_PL = 2**31 - 1


def qual_to_error_prob(q: Column) -> Column:
    return F.pow(F.lit(10.0), q / -10.0)


def qual_to_prob(q: Column) -> Column:
    return 1.0 - qual_to_error_prob(q)


def qual_to_prob_log10(q: Column) -> Column:
    return F.log10(qual_to_prob(q))


def error_prob_to_qual(p: Column) -> Column:
    """Bounded to 1..254."""
    return F.least(F.lit(MOST_QUAL), F.greatest(F.lit(1), F.round(-10.0 * F.log10(p)).cast("int")))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def phred_sum(phreds: Column) -> Column:
    return -10.0 * F.log10(total(F.transform(phreds, lambda x: F.pow(F.lit(10.0), x / -10.0))))


def log10_sum(values: Column) -> Column:
    """log10 of the sum of 10^x; -inf for an empty array. The largest value is taken out first."""
    top = F.array_max(values)
    return F.when(F.size(values) == 0, F.lit(float("-inf"))).otherwise(top + F.log10(total(F.transform(values, lambda x: F.pow(F.lit(10.0), x - top)))))


def log10_one_minus_pow10(a: Column) -> Column:
    """log10(1 - 10^a) for a <= 0."""
    b = a * math.log(10)
    return F.when(a > 0, F.lit(float("nan"))).when(a == 0, F.lit(float("-inf"))).otherwise(F.when(b < -math.log(2), F.log1p(-F.exp(b))).otherwise(F.log(-F.expm1(b))) / math.log(10))


def log10_factorial(n: Column) -> Column:
    """Sum of logs; exact to rounding for the small n of genotypes."""
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n.cast("int"), F.lit(1))), F.lit(0.0), lambda a, x: a + F.log10(x.cast("double")))


def log10_binomial(n: Column, k: Column) -> Column:
    return log10_factorial(n) - log10_factorial(k) - log10_factorial(n - k)


def normalize_log10(values: Column) -> Column:
    """Shifted so that 10^x sums to 1."""
    s = log10_sum(values)
    return F.transform(values, lambda x: x - s)


def scale_log10(values: Column) -> Column:
    """Shifted so that the largest is 0."""
    top = F.array_max(values)
    return F.transform(values, lambda x: x - top)


def ebe(a: Column, b: Column, how: str) -> Column:
    ops = {"add": lambda x, y: x + y, "subtract": lambda x, y: x - y, "multiply": lambda x, y: x * y}
    return F.zip_with(a, b, ops[how])


def dot(a: Column, b: Column) -> Column:
    return total(ebe(a, b, "multiply"))


def normal_density(mean, sd, x: Column) -> Column:
    return F.exp(-F.pow(x - mean, 2) / (2.0 * sd * sd)) / (sd * math.sqrt(2 * math.pi))


def fast_bernoulli_entropy(p: Column) -> Column:
    """Rational approximation of the entropy of a coin, in nats."""
    q = p * (1.0 - p)
    return q * (11.0 + 33.0 * q) / (2.0 + 20.0 * q)


def digamma(x: Column) -> Column:
    """For x > 0: the recurrence up to 6 and more, then the asymptotic series."""
    shift = F.when(x < 6, 6 - F.floor(x)).otherwise(0)
    y = x + shift
    lower = F.aggregate(F.when(shift > 0, F.sequence(F.lit(0), (shift - 1).cast("int"))).otherwise(F.array().cast("array<int>")), F.lit(0.0), lambda a, i: a + 1.0 / (x + i))
    s = 1.0 / (y * y)
    return F.log(y) - 0.5 / y - s * (1.0 / 12 - s * (1.0 / 120 - s * (1.0 / 252 - s * (1.0 / 240 - s / 132)))) - lower


def gls_to_pls(gls: Column) -> Column:
    """Phred-scaled, the best at 0, capped."""
    top = F.array_max(gls)
    return F.transform(gls, lambda g: F.least(F.lit(MOST_PL), F.round(-10.0 * (g - top))).cast("int"))


def gq(pls: Column, most: int = 99) -> Column:
    """Second smallest PL less the smallest."""
    s = F.array_sort(pls)
    return F.least(F.lit(most), F.when(F.size(s) > 1, s[1] - s[0]).otherwise(F.lit(0)))


def n_genotypes(ploidy: Column, alleles: Column) -> Column:
    """C(n + p - 1, p)."""
    return F.round(F.pow(F.lit(10.0), log10_binomial(alleles + ploidy - 1, ploidy))).cast("int")


def pcr_indel_qual(length: Column, rate: float) -> Column:
    """Gap quality after a repeat of ``length`` units."""
    return F.greatest(F.lit(6), F.floor(40.0 - F.exp(length / (rate * math.pi)) + 1.0).cast("int"))


def transition_probs(ins: Column, dele: Column, gcp: Column) -> Column:
    """struct<mm, im, mi, ii, md, dd> of the pair hidden Markov model."""
    e = qual_to_error_prob
    return F.struct((1.0 - (e(ins) + e(dele))).alias("mm"), (1.0 - e(gcp)).alias("im"), e(ins).alias("mi"), e(gcp).alias("ii"), e(dele).alias("md"), e(gcp).alias("dd"))


def cap_read_quals(quals: Column, mapq: Column, least: int = 18, low: int = 6) -> Column:
    """Capped by the mapping quality; under ``least`` a base counts as ``low``."""

    def one(q):
        c = F.least(q, mapq)
        return F.when(c < least, F.lit(low)).otherwise(c)

    return F.transform(quals, one)


def activity_prob(qual: Column) -> Column:
    """1 - 10^(-Q/10) with Q cut to 0..255."""
    return 1.0 - F.pow(F.lit(10.0), F.least(F.lit(255), F.greatest(F.lit(0), F.floor(qual))) / -10.0)


def jukes_cantor(p: Column) -> Column:
    q = F.when(p == 0.75, F.lit(0.7499)).otherwise(p)
    return -0.75 * F.log(1.0 - 4.0 * q / 3.0)


def dnds_ratio(nd: Column, n: Column, sd: Column, s: Column) -> Column:
    """NaN or a dS near 0 gives 1; negative gives 0."""
    dn, ds = jukes_cantor(nd / n), jukes_cantor(sd / s)
    r = dn / ds
    return F.when(ds.isNull() | dn.isNull() | F.isnan(ds) | F.isnan(dn) | (ds <= 2.3e-16), F.lit(1.0)).when(r < 0, F.lit(0.0)).otherwise(r)


def read_threshold(quals: Column, deviations: float = 1.0, error_rate: float = 0.02, capped: bool = True) -> Column:
    """log10 likelihood under which a read fits no haplotype.

    A base of quality Q, cut to 1..40, has the Phred-scaled likelihood x: that of no error, or of one error among three bases. The expected sum of x and ``deviations`` of its standard
    deviation make one bound, the likelihood of the errors that ``error_rate`` allows (two at most if ``capped``), at 10^-4 each, the other; the smaller counts. Qualities are those before any cap.
    """

    def moments(q):
        e = qual_to_error_prob(F.least(F.lit(40), F.greatest(F.lit(1), q)).cast("double"))
        no, yes = -10.0 * F.log10(1.0 - e), -10.0 * F.log10(e / 3.0)
        mean = (1.0 - e) * no + e * yes
        return mean, (1.0 - e) * no * no + e * yes * yes - mean * mean

    mean = total(F.transform(quals, lambda q: moments(q)[0]))
    var = total(F.transform(quals, lambda q: moments(q)[1]))
    errors = F.ceil(F.size(quals) * F.lit(error_rate)).cast("double")
    return F.least(-0.1 * (mean + deviations * F.sqrt(var)), -4.0 * (F.least(F.lit(2.0), errors) if capped else errors))
