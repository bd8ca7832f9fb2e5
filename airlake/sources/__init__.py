"""Readers and writers: raw envelopes, detections, dimensions, tables, snapshots."""
