"""Cleaning rules, dimension joins and the reports, as DataFrame functions.

Every report is pure and lazy: ``report(logs, cus, ...) -> DataFrame``.
"""
