"""carebook.operators"""
