"""emporia.streaming"""
