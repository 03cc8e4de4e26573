"""carebook.plans"""
