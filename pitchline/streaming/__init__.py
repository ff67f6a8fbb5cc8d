"""pitchline.streaming"""
