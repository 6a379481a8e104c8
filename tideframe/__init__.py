"""Tideframe: feature, quality, drift and forecasting operators for many time series on Spark."""
