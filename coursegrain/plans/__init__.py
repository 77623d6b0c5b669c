"""Whole-catalogue compositions."""
