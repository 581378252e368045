"""metrolens.plans"""
