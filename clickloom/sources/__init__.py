"""Readers for detector files, deployment sheets and vendor exports."""
