"""Whole models: staging, the reconciled day, the marts, and the batch job that writes them."""
