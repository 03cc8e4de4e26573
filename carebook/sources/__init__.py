"""carebook.sources"""
