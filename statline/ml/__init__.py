"""ml"""
