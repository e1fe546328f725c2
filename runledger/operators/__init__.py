"""Operators over envelopes and log rows."""
