"""Compositions: star schema, marts, legacy queries, batch adjustments, the batch run."""
