"""emporia.operators"""
