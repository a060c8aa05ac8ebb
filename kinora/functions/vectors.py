"""Array-of-double arithmetic as Catalyst expressions."""

from pyspark.sql import functions as F


def _total(values):
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b):
    return _total(F.zip_with(a, b, lambda x, y: x * y))


def l1_norm(a):
    return _total(F.transform(a, lambda x: F.abs(x)))


def l2_norm(a):
    return F.sqrt(_total(F.transform(a, lambda x: x * x)))


def lp_norm(a, p):
    return F.pow(_total(F.transform(a, lambda x: F.pow(F.abs(x), F.lit(float(p))))), F.lit(1.0 / p))


def squared_distance(a, b):
    return _total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def cosine(a, b):
    """Cosine, or null when a vector has zero length (division by zero is an error in ANSI mode)."""
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def scale(a, factor):
    return F.transform(a, lambda x: x * factor)


def centre(a):
    """Subtract the vector's own mean; cosine of centred vectors is Pearson's r."""
    mean = _total(a) / F.size(a)
    return F.transform(a, lambda x: x - mean)
