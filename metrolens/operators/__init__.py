"""metrolens.operators"""
