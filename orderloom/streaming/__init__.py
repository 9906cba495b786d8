"""Dated deliveries as a stream."""
