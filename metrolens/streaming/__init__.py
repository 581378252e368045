"""metrolens.streaming"""
