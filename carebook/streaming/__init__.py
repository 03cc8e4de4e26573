"""carebook.streaming"""
