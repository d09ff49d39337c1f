"""emporia.plans"""
