"""Demand regressors and the tote classifier.

What reaches the driver is bounded: factor levels, column means, pivot rows, Gram matrices,
coefficients and one-row metrics.
"""
