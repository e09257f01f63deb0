"""Inputs. Every reader takes its location and options from the caller."""
